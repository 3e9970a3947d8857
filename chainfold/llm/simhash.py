"""SimHash near-duplicates: candidates by equal bits, pairs discarded by a table of distances to pivots."""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chainfold.llm.buckets import forests, linked
from chainfold.llm.common import MIX, arrow_pass, mix, query, shingles, stored, table, text_bytes, without, word_hashes
from chainfold.llm.components import components
from chainfold.llm.passages import SIMILARITY, alike

SEED = 42
PIVOTS = 16
ROWS = 1 << 15
LANES = np.arange(64, dtype=np.uint64) * MIX
CELLS = 24              # bits of a cell in the bitmap of texts to compare
SETS = 256              # shingle sets that a block holds
WEIGHT = 1 << 22        # and shingles in them, unless one set has more
FIRST = 8               # tables whose edges are put together before many others are looked at


def fingerprint(text: bytes, words: int = 4, lanes: int = 1) -> bytes:
    """A SimHash of 64 * lanes bits over shingles of ``words`` words, A-Z as a-z; repeats count.

    The first lane uses XXH64 with seed 42, the others are derived from it. Fewer words than a shingle count as one
    shingle; no word at all gives zero.
    """
    parts = text.lower().split()
    if not parts:
        return bytes(8 * lanes)
    width = min(words, len(parts))
    whole = b" ".join(parts)
    ends = list(itertools.accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends]
    hashed, digest = b"".join, xxhash.xxh64_digest
    spans = list(zip(starts, ends[width - 1:]))
    ones = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(spans), ROWS):
        block = hashed([digest(whole[s:e - 1], SEED) for s, e in spans[at:at + ROWS]])
        first = np.frombuffer(block, ">u8")
        for lane in range(lanes):
            value = first if lane == 0 else mix(first.astype(np.uint64) + LANES[lane]).astype(">u8")
            ones[64 * lane:64 * lane + 64] += np.unpackbits(value.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(spans)).tobytes()


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes, A-Z as a-z; fewer words than a shingle count as one shingle."""
    return np.unique(shingles(word_hashes(text), words))


def set_print(distinct: np.ndarray, lanes: int) -> bytes:
    """A SimHash of 64 * lanes bits over distinct shingles, each counted once; no shingle gives zero."""
    ones = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(distinct), ROWS):
        part = distinct[at:at + ROWS]
        for lane in range(lanes):
            value = mix(part + LANES[lane]).astype(">u8")
            ones[64 * lane:64 * lane + 64] += np.unpackbits(value.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(distinct)).tobytes()


def words_of(prints: list[bytes] | np.ndarray) -> np.ndarray:
    """Fingerprints as rows of 64-bit numbers."""
    size = len(prints[0]) // 8
    return np.frombuffer(b"".join(prints), ">u8").astype(np.uint64).reshape(-1, size)


def pivots(lanes: int) -> np.ndarray:
    """The reference fingerprints: fixed, spread evenly, the same for every corpus."""
    return mix(np.arange(1, PIVOTS * lanes + 1, dtype=np.uint64) * MIX).reshape(PIVOTS, lanes)


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """The Hamming distance of each fingerprint to each pivot."""
    return np.stack([np.bitwise_count(prints ^ p).sum(1) for p in pivots(prints.shape[1])], axis=1).astype(np.int16)


def _decoded(columns):
    return words_of(columns[1]), np.frombuffer(b"".join(columns[2]), np.int16).reshape(len(columns[2]), PIVOTS)


def close_by(max_bits: int):
    """Which members of a bucket are within ``max_bits`` of a member.

    Hamming distance is a metric: where two coordinates differ by more than ``max_bits``, so do the fingerprints. Only
    what all pivots leave is compared bit by bit.
    """
    def close(columns):
        prints, far = _decoded(columns)

        def near(i: int) -> np.ndarray:
            kept = np.flatnonzero(np.abs(far - far[i]).max(1) <= max_bits)
            out = np.zeros(len(prints), bool)
            out[kept[np.bitwise_count(prints[kept] ^ prints[i]).sum(1) <= max_bits]] = True
            return out
        return near
    return close


def pairs_by(max_bits: int):
    """The same for many pairs at once: members i[n] and j[n]."""
    def pairs(columns, i, j):
        prints, far = _decoded(columns)
        kept = np.flatnonzero(np.abs(far[i] - far[j]).max(1) <= max_bits)
        out = np.zeros(len(i), bool)
        out[kept] = np.bitwise_count(prints[i[kept]] ^ prints[j[kept]]).sum(1) <= max_bits
        return out
    return pairs


def exact_tables(count: int, bits: int, max_bits: int) -> list[np.ndarray]:
    """Bit positions of each table so that every pair within ``max_bits`` agrees on all bits of some table.

    The bits are cut into max_bits + e blocks; differing bits touch at most max_bits of them, so e blocks agree. e grows
    until a bucket holds about one fingerprint by chance.
    """
    same = 2
    while bits * same / (max_bits + same) < math.log2(max(2, count)) and same < bits - max_bits:
        same += 1
    blocks = np.array_split(np.arange(bits), max_bits + same)
    return [np.concatenate(chosen) for chosen in itertools.combinations(blocks, same)]


def sampled_tables(count: int, bits: int, max_bits: int, recall: float) -> list[np.ndarray]:
    """Random bit positions of each table, as many tables as find a pair at SIMILARITY with probability ``recall``.

    The distance of such a pair is binomial. The mean goes over all distances up to ``max_bits``; what lies beyond is missed
    and counts against the recall. Wider tables, for more rows, agree less often, so there are more of them.
    """
    width = min(44, max(18, math.ceil(math.log2(max(2, count))) + 2))
    share = math.acos(2 * SIMILARITY / (1 + SIMILARITY)) / math.pi
    chance = np.array([math.comb(bits, d) * share ** d * (1 - share) ** (bits - d) for d in range(max_bits + 1)])
    hit = np.array([math.prod(max(0, bits - d - k) / (bits - k) for k in range(width)) for d in range(max_bits + 1)])
    found = lambda tables: chance @ (1 - (1 - hit) ** tables)
    if chance.sum() <= recall:
        raise ValueError("max_bits is too small for this recall")
    low, high = 0, 1
    while found(high) < recall:
        low, high = high, 2 * high
    while high - low > 1:
        half = (low + high) // 2
        low, high = (low, half) if found(half) >= recall else (half, high)
    draw = np.random.default_rng(SEED)
    return [np.sort(draw.choice(bits, width, replace=False)) for _ in range(high)]


def near_edges(prints: DataFrame, lanes: int, max_bits: int, recall: float | None = None) -> DataFrame:
    """Edges (a, b) of node ids that connect the fingerprints of ``prints`` (id, p) within ``max_bits`` of each other.

    Without ``recall`` every such pair is found; else one whose texts are at SIMILARITY with that probability. Where tables are
    many, the first few connect most of a family, and the others give edges between the components found so far only:
    so a family costs a few edges a member, not one for each table.
    """
    count, bits = prints.count(), 64 * lanes
    tables = exact_tables(count, bits, max_bits) if recall is None else sampled_tables(count, bits, max_bits, recall)
    marks = np.arange(1, len(tables) + 1, dtype=np.uint64) * MIX

    def keys(batch: pa.RecordBatch) -> dict:
        raw = batch.column(1).to_pylist()
        spread = np.unpackbits(np.frombuffer(b"".join(raw), np.uint8)).reshape(len(raw), bits)
        out = np.empty((len(raw), len(tables)), np.int64)
        for i, chosen in enumerate(tables):
            value = np.zeros(len(raw), np.uint64)
            for at in chosen:
                value = (value << np.uint64(1)) | spread[:, at]
            out[:, i] = mix(value + marks[i]).view(np.int64)
        return {"node": batch.column(0), "keys": list(out)}

    def measured(batch: pa.RecordBatch) -> dict:
        raw = batch.column(1).to_pylist()
        return {"id": batch.column(0), "p": raw, "far": [row.tobytes() for row in pivot_table(words_of(raw))]}
    ids = prints.select("id", "p")
    keyed = arrow_pass(ids, "node bigint, keys array<bigint>", keys)
    payload = arrow_pass(ids, "id bigint, p binary, far binary", measured)

    def edges(start: int, stop: int, payload: DataFrame, label: str | None = None) -> DataFrame:
        rows = keyed.select(F.explode(F.slice("keys", start + 1, stop - start)).alias("key"), "node")
        return linked(rows, payload, close_by(max_bits), pairs_by(max_bits), label=label)
    if len(tables) <= 2 * FIRST:
        return edges(0, len(tables), payload)
    roots = stored(components(edges(0, FIRST, payload), "a", "b"))
    labelled = payload.join(roots, F.col("id") == F.col("node"), "left").select("id", "p", "far", F.coalesce("root", "id").alias("label"))
    known = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return known.unionByName(edges(FIRST, len(tables), labelled, "label"))


def with_fingerprint(docs: DataFrame, text: str, name: str, words: int = 4, lanes: int = 1) -> DataFrame:
    def printed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words, lanes) for t in texts], dtype=object)
    printed = F.pandas_udf(printed, "binary")
    return docs.withColumn(name, printed(text_bytes(text)))


def grouped(prints: DataFrame, best, **reach) -> DataFrame:
    """(q, best) for each distinct fingerprint p of ``prints``: the least ``best`` in its component."""
    distinct = stored(prints.groupBy("p").agg(F.min(best).alias("first")).withColumn("id", F.monotonically_increasing_id()))
    roots = components(near_edges(distinct, **reach), "a", "b")
    rooted = distinct.join(roots, F.col("id") == F.col("node"), "left").select("p", "first", F.coalesce("root", "id").alias("root"))
    least = rooted.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("best"))
    return rooted.join(least, F.col("root") == F.col("r")).select(F.col("p").alias("q"), "best")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, lanes: int = 1,
                    max_bits: int = 4) -> DataFrame:
    """One row per document: its id, fingerprint (hexadecimal) and component_id.

    Fingerprints within ``max_bits`` differing bits are linked, all of them; component_id is the smallest id reachable. Null
    counts as empty text; texts without words have fingerprint zero, which links like any other. Repeated rows stay
    repeated. A null id is never the smallest; a component of null ids only has component_id null. An empty table gives no
    row. Other columns of ``docs`` are not looked at.
    """
    prints = stored(with_fingerprint(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), "text", "p",
                                     words, lanes).select("doc_id", "p"))
    named = grouped(prints, F.col("doc_id"), lanes=lanes, max_bits=max_bits)
    return prints.join(named, F.col("p") == F.col("q")).select(
        "doc_id", F.lower(F.hex("p")).alias("fingerprint"), F.col("best").alias("component_id"))


@query("op9_simhash_pivots")
def op9_simhash_pivots(spark, d):
    return near_duplicates(table(spark, d, "documents"))


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles): the distinct shingles of the texts of ``docs`` (mark, text) that ``wanted`` (node, mark) asks for.

    A bitmap of fixed size goes to tasks ahead, so that only texts it lets through are cut, and no text is shuffled.
    """
    cell = F.shiftrightunsigned("mark", 64 - CELLS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(mark, {64 - CELLS}) & 63 as int))")
    bitmap = np.zeros(1 << (CELLS - 6), np.uint64)
    for r in wanted.groupBy(F.shiftright(cell, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        bitmap[r.word] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def cut(batch: pa.RecordBatch) -> dict:
        at = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - CELLS)
        hit = np.flatnonzero(held.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1))
        texts = batch.column(1)
        return {"mark": batch.column(0).take(pa.array(hit)),
                "shingles": [shingle_set(texts[int(i)].as_py(), words).view(np.int64) for i in hit]}
    cut_ = arrow_pass(docs, "mark bigint, shingles array<bigint>", cut)
    asked = wanted.select("node", F.col("mark").alias("m"))
    return cut_.join(asked, F.col("mark") == F.col("m")).select("node", "shingles").dropDuplicates(["node"])


def verified(loose: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root): the members of each loose component (root, node) that chains of alike sets (node, shingles) connect.

    A component of up to SETS members and WEIGHT shingles is one block. A larger one is dealt into blocks; then each tree
    found there sends its smallest member, and these are dealt and compared in turn, while a round leaves half of them or
    fewer. So a family of near copies is one tree before blocks meet in pairs. Members of trees still apart are then
    compared whole: blocks of one large tree, or of several small ones, meet all others but those of the same tree, and
    give links between trees only. Nodes that nothing connects have no row.
    """
    payload = sets.withColumnRenamed("node", "id")
    loose = stored(loose.join(sets.select("node", F.size("shingles").alias("weight")), "node"))
    parts = F.ceil(F.greatest(F.col("n") / SETS, F.col("w") / WEIGHT)).cast("int")
    load = [F.count("*").alias("n"), F.sum("weight").alias("w")]
    crowded = loose.groupBy("root").agg(*load).where(parts > 1).select("root")
    heads, before, edges = loose, None, None
    for turn in itertools.count():
        dealt = heads.join(heads.groupBy("root").agg(*load), "root").select(
            F.xxhash64(F.lit(turn), "root", F.pmod(F.xxhash64("node", F.lit(turn)), parts)).alias("key"), "node")
        now = stored(linked(dealt, payload, alike, block=2 * SETS))
        edges = now if edges is None else edges.unionByName(now)
        roots = stored(components(edges, "a", "b"))
        trees = stored(loose.join(crowded, "root", "left_semi").join(
            roots.select("node", F.col("root").alias("r")), "node", "left").select(
            "root", "node", "weight", F.coalesce("r", "node").alias("tree")))
        heads = trees.where("tree = node").select("root", "node", "weight")
        heads = stored(heads.join(heads.groupBy("root").count().where("count > 1"), "root", "left_semi"))
        left = heads.count()
        if left == 0:
            return roots
        if before is not None and left > before / 2:
            break
        before = left
    apart = trees.join(heads.select("root").distinct(), "root", "left_semi")
    large = apart.groupBy("root", "tree").agg(*load).withColumn("own", parts)
    small = large.where("own = 1").groupBy("root").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).select("root", parts.alias("shared"))
    alone = F.col("own") > 1
    placed = apart.join(large.select("root", "tree", "own"), ["root", "tree"]).join(small, "root", "left").select(
        "root", "node", "tree", F.when(alone, F.col("tree")).alias("only"),
        F.when(alone, F.xxhash64(F.lit(1), "tree", F.pmod(F.xxhash64("node"), F.col("own"))))
        .otherwise(F.xxhash64(F.lit(2), "root", F.pmod(F.xxhash64("tree"), F.col("shared")))).alias("block"))
    blocks = stored(placed.select("root", "block", "only").distinct())
    other = blocks.select(F.col("root").alias("r"), F.col("block").alias("b"), F.col("only").alias("o"))
    met = blocks.join(other, (F.col("root") == F.col("r")) & (F.col("block") <= F.col("b"))
                      & F.coalesce(F.col("only") != F.col("o"), F.lit(True)))
    asked = met.select(F.xxhash64("root", "block", "b").alias("_g"), F.explode(F.array_distinct(F.array("block", "b"))).alias("at"))
    between = asked.join(placed, F.col("at") == F.col("block")).select("_g", F.col("root").alias("_k"), F.col("tree").alias("label"), "node").join(
        sets, "node").select("_g", "_k", "label", "shingles")
    return components(edges.unionByName(forests(between, ["label", "shingles"], alike)), "a", "b")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, lanes: int = 4,
             max_bits: int = 57, recall: float = 0.97) -> DataFrame:
    """The documents that stay when one document of each group of near copies is kept, that of the smallest id.

    Two texts are near copies if the sets of their five-word shingles have an exact Jaccard similarity of SIMILARITY (0.8) or
    more; groups are the components of such pairs. Fingerprints of the sets only find candidates: at that similarity the
    angle is 0.476, so 39 of 256 bits differ on average, and ``max_bits`` leaves out one such pair in a thousand. The tables find
    a pair at 0.8 with probability ``recall``, whatever the row count, closer ones more surely. All pairs of texts that
    candidates connect, over whatever chain, are compared exactly; equal sets need no look.

    Ties of the id are broken by the text; rows that repeat both stay together. Null counts as empty text, a null id sorts
    first; texts without words are copies of each other. All columns are kept.
    """
    mark = F.xxhash64(F.col(id).cast("string"), text_bytes(text))

    def printed(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, words) for t in batch.column(2).to_pylist()]
        return {"doc_id": batch.column(0), "mark": batch.column(1), "p": [set_print(s, lanes) for s in sets],
                "content": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]}
    kind = docs.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()
    prints = stored(arrow_pass(docs.select(F.col(id), mark, text_bytes(text)), f"doc_id {kind}, mark bigint, p binary, content binary", printed))
    nodes = stored(prints.groupBy("content").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.first("p").alias("p"))
                   .withColumn("id", F.monotonically_increasing_id()))
    loose = stored(components(near_edges(nodes, lanes, max_bits, recall), "a", "b").select("root", F.col("node").alias("id")).join(
        nodes.select("id", F.col("first.mark").alias("mark")), "id").select("root", F.col("id").alias("node"), "mark"))
    sets = stored(sets_of(docs.select(mark.alias("mark"), text_bytes(text).alias("text")), loose.select("node", "mark"), words))
    roots = verified(loose.select("root", "node"), sets)
    rooted = nodes.join(roots, F.col("id") == F.col("node"), "left").select("content", "first", F.coalesce("root", "id").alias("root"))
    least = rooted.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("best"))
    named = rooted.join(least, F.col("root") == F.col("r")).select(F.col("content").alias("c"), "best")
    gone = prints.join(named, F.col("content") == F.col("c")).where("mark != best.mark").select("mark").distinct()
    return without(docs, mark, gone)
