"""Passages that repeat across documents: MinHash banding over paragraphs and anchored windows, exact Jaccard, components."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chainfold.llm.buckets import linked
from chainfold.llm.common import MIX, SLICE, arrow_pass, mix, query, shingles, stored, table, text_bytes, words_and_lines
from chainfold.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
PARAGRAPH = 5           # words that a paragraph has at least
WINDOW = 20             # words of an anchored window
GAP = 27                # shingle positions without an anchor, at most; GAP + WINDOW + 3 <= 50
RECALL = 0.99           # of the bands, for a pair at SIMILARITY
ALL_EQUAL = math.ceil(SIMILARITY / (1 - SIMILARITY) - 1e-9) - 1   # shingles up to which similar sets are equal sets
ODDS = mix(np.arange(1, 65, dtype=np.uint64) * MIX) | np.uint64(1)      # one order of all shingles each, as these are well mixed
NODE = 1 << 31          # more than the words of any text: a place is first word * NODE + words


def tune(similarity: float, recall: float, hashes: int = 16) -> tuple[int, int]:
    """(bands, rows) with which a pair at ``similarity`` collides with probability ``recall``.

    The fewest bands of two rows or more, as each band is a row to shuffle; then the most rows in them.
    """
    best = None
    for rows in range(2, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))
        if bands * rows <= hashes and (best is None or bands <= best[0]):
            best = (bands, rows)
    return best


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The least (or greatest) value of each run of ``width``, by doubling."""
    out, size = values, 1
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    return pick(out[:len(values) - width + 1], out[width - size:]) if size < width else out


def anchored(hashed: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions with the least hash of some run of GAP positions in a text: the same in every copy of a passage.

    Several texts are looked at at once: owner is the text of each word, and a run or shingle lies in one text.
    """
    whole = owner[:len(hashed)] == owner[SHINGLE - 1:]
    marked = np.zeros(len(hashed), bool)
    if len(hashed) >= GAP:
        least = sliding(hashed, GAP, np.minimum)
        least[owner[:len(least)] != owner[GAP + SHINGLE - 2:]] = 0      # a run lies in one text
        padded = np.r_[np.zeros(GAP - 1, np.uint64), least, np.zeros(GAP - 1, np.uint64)]
        marked = (sliding(padded, GAP, np.maximum) == hashed) & whole
    # a text with no whole run has its least hash as anchor
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    sizes = np.diff(np.r_[starts, len(owner)])
    for start, size in zip(starts[sizes < GAP + SHINGLE - 1].tolist(), sizes[sizes < GAP + SHINGLE - 1].tolist(), strict=True):
        own = hashed[start:start + size - SHINGLE + 1]
        marked[start:start + len(own)] = own == own.min()
    return np.flatnonzero(marked)


class Pieces:
    """The paragraphs and windows of some texts, cut together, as lines of one text, since many are short.

    A paragraph is a line of PARAGRAPH words or more. Windows of WINDOW words start at anchors, so that a passage of over 50
    words holds the same window wherever it stands, also within a line. Per unit, paragraphs first: text (its number), first (word
    of its text), count (of words), content (a hash of all its words). ``once`` are the units with the first place of a content in
    a text, ``later`` its other places, by text and content.
    """

    def __init__(self, texts: list[bytes]):
        words, lines = words_and_lines(b"\n".join(texts))
        owner = np.searchsorted(np.cumsum([t.count(b"\n") + 1 for t in texts]), lines, "right")
        enough = np.bincount(owner, minlength=len(texts))[owner] >= PARAGRAPH
        words, lines, owner = words[enough], lines[enough], owner[enough]
        self.hashed = shingles(words, SHINGLE)
        border = np.flatnonzero(np.r_[True, lines[1:] != lines[:-1], True]) if len(words) else np.zeros(1, np.int64)
        sizes, step = np.diff(border), np.uint64(0x9E3779B1)
        # the content by sums of words marked with their place in the unit
        inside = (np.arange(len(words)) - np.repeat(border[:-1], sizes)).astype(np.uint64)
        content = np.add.reduceat(mix(words + inside * step), border[:-1])[sizes >= PARAGRAPH] if len(words) else words
        self.starts, self.sizes = border[:-1][sizes >= PARAGRAPH], sizes[sizes >= PARAGRAPH]
        at = anchored(self.hashed, owner) if len(words) else border[:0]
        at = at[at + WINDOW <= len(words)]
        self.at = at = at[owner[at] == owner[at + WINDOW - 1]]
        if len(at):
            content = np.r_[content, sum(mix(words[at + i] + np.uint64(i) * step) for i in range(WINDOW))]
        first = np.r_[self.starts, at]
        self.content, self.count, self.text = content, np.r_[self.sizes, np.full(len(at), WINDOW)], owner[first]
        self.first = first - np.searchsorted(owner, self.text)
        order = np.lexsort((self.first, content, self.text))
        again, same = np.zeros(len(order), bool), np.zeros(len(order), bool)
        again[1:] = (content[order[1:]] == content[order[:-1]]) & (self.text[order[1:]] == self.text[order[:-1]])
        same[1:] = again[1:] & (self.first[order[1:]] == self.first[order[:-1]])      # a line that is a window too
        self.once, self.later = np.sort(order[~again]), order[again & ~same]

    def banded(self) -> tuple[np.ndarray, np.ndarray]:
        """(key, unit): a row for each band of each unit in ``once``."""
        lines = self.once[self.once < len(self.starts)]
        windows = self.once[len(lines):] - len(self.starts)
        keys, units_ = [], []
        bands, deep = tune(SIMILARITY, RECALL)
        # short lines are similar only to lines of the same shingles, which agree in every band
        long_ = lines[self.sizes[lines] >= SHINGLE + ALL_EQUAL]
        edges = np.c_[self.starts, self.starts + self.sizes - SHINGLE + 1].ravel()
        edges = edges[:-1] if len(edges) and edges[-1] >= len(self.hashed) else edges
        band, wide = np.zeros(len(self.starts), np.uint64), np.zeros(len(windows), np.uint64)
        for k in range(bands * deep):
            value, last = self.hashed * ODDS[k], k % deep == deep - 1
            if len(lines):
                band = mix(band + np.minimum.reduceat(value, edges)[::2])
                if last:
                    chosen = lines if k < deep else long_
                    keys.append(band[chosen] + np.uint64(k))
                    units_.append(chosen)
                    band = np.zeros(len(self.starts), np.uint64)
            if len(windows):
                wide = mix(wide + sliding(value, WINDOW - SHINGLE + 1, np.minimum)[self.at[windows]])
                if last:
                    keys.append(wide + np.uint64(k))
                    units_.append(windows + len(self.starts))
                    wide = np.zeros(len(windows), np.uint64)
        if not keys:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return mix(np.concatenate(keys) * MIX), np.concatenate(units_)


def units(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, content, first word, words): a row for each band of each paragraph and window of a text."""
    cut = Pieces([text])
    key, row = cut.banded()
    return key, cut.content[row], cut.first[row], cut.count[row]


def together(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about SLICE bytes in all, with the number of texts before; a longer text is alone or the last."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE:
            yield start, texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in key order, those whose key several documents have; a long run is passed on as it comes."""
    rest, open_ = None, None        # rows of a key of one document so far; a key known to be shared
    for batch in batches:
        rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
        key, doc = rows.column("key").to_numpy(), rows.column("doc").to_numpy()
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        shared = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
        shared |= key[starts] == open_ if open_ is not None else False
        sizes = np.diff(np.r_[starts, len(key)])
        take = np.repeat(shared, sizes)
        open_ = key[-1] if shared[-1] else None
        rest = None if shared[-1] else rows.slice(starts[-1])
        if take.any():
            yield from rows.filter(pa.array(take)).combine_chunks().to_batches()


def alike(columns):
    """Which members of a bucket have an exact Jaccard similarity of SIMILARITY or more with a member."""
    sets = [np.unique(np.asarray(s)) for s in columns[1]]
    sizes = np.array([len(s) for s in sets])
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]

    def near(i: int) -> np.ndarray:
        low, high = np.searchsorted(every, sets[i], "left"), np.searchsorted(every, sets[i], "right")
        spans = high - low
        at = np.repeat(low - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(spans.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        return both >= SIMILARITY * (sizes + sizes[i] - both)
    return near


def columns(batch: pa.RecordBatch, choose: Callable[[Pieces], tuple[np.ndarray, np.ndarray]]) -> dict:
    """The chosen units (key, unit) of a batch (doc, text) as columns."""
    out = []
    for start, some in together(batch.column(1).to_pylist()):
        cut = Pieces(some)
        key, row = choose(cut)
        out.append((start + cut.text[row], key, cut.content[row], cut.first[row] * NODE + cut.count[row]))
    text, key, content, place = (np.concatenate(c) for c in zip(*out, strict=True))
    return {"key": key.view(np.int64), "content": content.view(np.int64), "doc": batch.column(0).to_numpy()[text], "place": place}


def repeated_passages(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with a repeated passage: doc_id, passages, removed_words, keeps_all.

    ``passages`` has, in order, first_word and last_word (exclusive), class_id, keep_doc_id (the smallest id of the class) and
    removed (another document keeps it). A class is a component of units that are equal or have a Jaccard similarity of
    0.8 of their five-word shingles, A-Z as a-z, and that at least two documents hold. All places of a unit in a document are
    passages. removed_words counts the words in removed passages once.

    The id must be an integer; rows without id are left out. Rows that repeat an id count as one document, so they do not
    repeat each other. Null, empty and short texts hold no unit; an empty table gives no row; other columns are not looked at.
    A passage that a third of all documents hold is never gathered: its rows pass in a stream, and its members are compared
    once per distinct content.
    """
    base = docs.where(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("doc"), text_bytes(text).alias("text"))

    def cut_units(batch: pa.RecordBatch) -> dict:
        return columns(batch, Pieces.banded)

    def cut_later(batch: pa.RecordBatch) -> dict:
        out = columns(batch, lambda cut: (cut.content[cut.later], cut.later))
        content, doc = out["content"], out["doc"]
        border = np.flatnonzero(np.r_[True, (content[1:] != content[:-1]) | (doc[1:] != doc[:-1]), True]) if len(doc) else np.zeros(1, int)
        return {"content": content[border[:-1]], "doc": doc[border[:-1]],
                "places": pa.ListArray.from_arrays(pa.array(border, pa.int32()), pa.array(out["place"]))}
    schema = "key bigint, content bigint, doc bigint, place bigint"
    found = stored(arrow_pass(base, schema, cut_units).repartition("key").sortWithinPartitions("key").mapInArrow(_shared, schema))
    later = arrow_pass(base, "content bigint, doc bigint, places array<bigint>", cut_later)
    # buckets of several contents are verified; equal content needs no look
    several = found.groupBy(F.col("key").alias("k")).agg(F.min("content").alias("low"), F.max("content").alias("high")).where("low != high").select("k")
    pairs = stored(found.join(several, F.col("key") == F.col("k"), "left_semi").groupBy("key", "content").agg(
        F.min(F.struct("doc", "place")).alias("at")))
    wanted = pairs.groupBy("content").agg(F.min("at").alias("at")).select("content", "at.doc", "at.place")

    def cut_shingles(batch: pa.RecordBatch) -> dict:
        out = {"content": [], "shingles": []}
        for t, each in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_and_lines(t)[0]
            for one in each:
                first, count = divmod(one["place"], NODE)
                out["content"].append(one["content"])
                out["shingles"].append(shingles(words[first:first + count], SHINGLE).view(np.int64))
        return out
    by_doc = wanted.groupBy(F.col("doc").alias("d")).agg(F.collect_list(F.struct("content", "place")).alias("each"))
    sets = arrow_pass(base.join(by_doc.hint("shuffle_hash"), F.col("doc") == F.col("d")).select("text", "each"),
                      "content bigint, shingles array<bigint>", cut_shingles).withColumnRenamed("content", "c").dropDuplicates(["c"])
    edges = linked(pairs.select("key", F.col("content").alias("node")), sets, alike)
    roots = components(edges, "a", "b")
    # a content in one document only has no class in another, so its later places go with the classes of one document
    members = found.select("content", "doc", F.array("place").alias("places")).distinct().unionByName(later).join(
        roots, F.col("content") == F.col("node"), "left").select("doc", "places", F.coalesce("root", "content").alias("class_id"))
    classes = members.groupBy(F.col("class_id").alias("cls")).agg(F.min("doc").alias("keep_doc_id"), F.max("doc").alias("last")).where("keep_doc_id != last")
    held = members.join(classes, F.col("class_id") == F.col("cls")).groupBy("doc").agg(F.collect_list(F.struct("class_id", "keep_doc_id", "places")).alias("held"))
    spans = F.array_sort(F.flatten(F.transform("held", lambda h: F.transform(h.places, lambda p: F.struct(
        F.shiftright(p, 31).alias("first_word"), (F.shiftright(p, 31) + p.bitwiseAND(NODE - 1)).alias("last_word"), h.class_id.alias("class_id"),
        h.keep_doc_id.alias("keep_doc_id"), (F.col("doc") != h.keep_doc_id).alias("removed"))))))
    cover = F.aggregate(F.filter("passages", lambda s: s.removed), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
                        lambda a, s: F.struct((a.n + F.greatest(F.lit(0).cast("long"), s.last_word - F.greatest(a.to, s.first_word))).alias("n"),
                                              F.greatest(a.to, s.last_word).alias("to")), lambda a: a.n)
    # rows that repeat an id may repeat a span
    new = F.filter("spans", lambda s, i: (i == 0) | (s != F.get("spans", i - 1)))
    return held.select("doc", spans.alias("spans")).select("doc", new.alias("passages")).select(
        F.col("doc").alias("doc_id"), "passages", cover.alias("removed_words")).withColumn("keeps_all", F.col("removed_words") == 0)


@query("op7_paragraph_minhash")
def op7_paragraph_minhash(spark, d):
    return repeated_passages(table(spark, d, "documents"))
