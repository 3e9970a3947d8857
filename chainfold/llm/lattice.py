"""Language-model scores of texts: the probability of a text is the sum over all its segmentations into subwords."""

from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chainfold.llm.common import MIX, arrow_pass, mix, query, remainder, stored, table, text_bytes

MARK = "▁"         # what pieces have for the space before a word
FREQUENT = 1 << 17      # words that are at least 1 / FREQUENT of all tokens are looked up in tasks: never more than FREQUENT
PRIOR_COUNT = 1000.0    # weight of the vocabulary's own scores against the counts of the corpus
DISCOUNT = 0.75         # taken from the count of each known word and given to the lattice of pieces
LONG = 96               # bytes; longer words are scored one by one
TASK_WORDS = 150_000    # distinct words that a task counts before it passes them on
STEP = np.uint64(0x100000001B3)
LEVELS = np.arange(64, dtype=np.uint64) * MIX


def tokenizer_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces as bytes (a leading space for the word mark) and their log probabilities; every byte is a piece too."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        self.pieces, self.logs = pieces, logs
        self.index = {p: i for i, p in enumerate(pieces)}
        self.lengths = sorted({len(p) for p in pieces})
        self._levels: list[tuple] | None = None

    def levels(self) -> list[tuple]:
        """Tables hash -> piece: what finds its cell taken goes to the next level."""
        if self._levels is None:
            hashes = np.array([_hash(p) for p in self.pieces], np.uint64)
            left, self._levels = np.arange(len(hashes)), []
            while len(left):
                size = 1 << max(10, int(len(left) * 8).bit_length())
                cell = (mix(hashes[left] + LEVELS[len(self._levels)]) & np.uint64(size - 1)).astype(np.int64)
                _, first = np.unique(cell, return_index=True)
                held, ids = np.zeros(size, np.uint64), np.zeros(size, np.int32)
                held[cell[first]], ids[cell[first]] = hashes[left[first]], left[first]
                self._levels.append((held, ids))
                left = np.delete(left, first)
        return self._levels

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or the number of pieces."""
        out = np.full(len(hashes), len(self.pieces), np.int32)
        for level, (held, ids) in enumerate(self.levels()):
            cell = (mix(hashes + LEVELS[level]) & np.uint64(len(held) - 1)).astype(np.int64)
            hit = held[cell] == hashes
            out[hit] = ids[cell[hit]]
        return out

    def with_counts(self, counts: dict[int, float]) -> "Vocabulary":
        """Probabilities from expected counts, smoothed by the probabilities held so far."""
        mass = PRIOR_COUNT * np.exp(self.logs)
        for i, n in counts.items():
            mass[i] += n
        return Vocabulary(self.pieces, np.log(mass / mass.sum()))


def _hash(piece: bytes) -> int:
    value = 0
    for b in piece:
        value = (value * int(STEP) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return value


def existing(path: str | None = None) -> Vocabulary:
    """The vocabulary of a tokenizer file. Its scores order the pieces; a piece of score -r weighs 1 / (r + e).

    Control pieces and pieces with A-Z, which lower-cased texts never hold, are left out; bytes come last.
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path or tokenizer_file())
    weight: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) and not any("A" <= c <= "Z" for c in piece):
            raw = piece.replace(MARK, " ").encode()
            weight[raw] = weight.get(raw, 0.0) + 1.0 / (math.e - model.get_score(i))
    for b in range(256):
        weight.setdefault(bytes((b,)), 1.0 / (math.e + model.get_piece_size()))
    pieces = sorted(weight)
    mass = np.array([weight[p] for p in pieces])
    return Vocabulary(pieces, np.log(mass / mass.sum()))


def _sum_logs(terms: np.ndarray) -> np.ndarray:
    most = terms.max(0)
    safe = np.where(np.isfinite(most), most, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(terms - safe).sum(0))


def _forward(word: bytes, v: Vocabulary) -> list[float]:
    """The forward recursion for a single long word."""
    most, index, logs = max(v.lengths), v.index, v.logs.tolist()
    alpha = [0.0] * (len(word) + 1)
    for j in range(1, len(word) + 1):
        terms = [alpha[j - n] + logs[i] for n in range(1, min(j, most) + 1) if (i := index.get(word[j - n:j])) is not None]
        top = max(terms)
        alpha[j] = top + math.log(sum(math.exp(t - top) for t in terms))
    return alpha


def _one_word(word: bytes, v: Vocabulary) -> float:
    return _forward(word, v)[-1]


def _count_pieces(word: bytes, v: Vocabulary, total: np.ndarray) -> None:
    """Add the expected pieces of a single long word to ``total``: the backward recursion behind the forward one."""
    most, index, logs, alpha = max(v.lengths), v.index, v.logs.tolist(), _forward(word, v)
    beta = [0.0] * (len(word) + 1)
    for j in range(len(word) - 1, -1, -1):
        arcs = [(i, logs[i] + beta[j + n]) for n in range(1, min(len(word) - j, most) + 1) if (i := index.get(word[j:j + n])) is not None]
        for i, through in arcs:
            total[i] += math.exp(alpha[j] + through - alpha[-1])
        top = max(through for _, through in arcs)
        beta[j] = top + math.log(sum(math.exp(through - top) for _, through in arcs))


def _lattices(words: list[bytes], v: Vocabulary):
    """For words of one length: the piece ending at j of each length, as (j, length, pieces of all words)."""
    size = len(words[0])
    data = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), size).T.astype(np.uint64)
    ahead = [np.zeros(len(words), np.uint64)]
    for row in data:
        ahead.append(ahead[-1] * STEP + row + np.uint64(1))
    power = [np.uint64(1)]
    for _ in range(size):
        power.append(np.uint64(int(power[-1]) * int(STEP) & 0xFFFFFFFFFFFFFFFF))
    for j in range(1, size + 1):
        lengths = [n for n in v.lengths if n <= j]
        yield j, lengths, v.find(np.concatenate([ahead[j] - ahead[j - n] * power[n] for n in lengths])).reshape(len(lengths), len(words))


def word_logs(words: list[bytes], v: Vocabulary) -> np.ndarray:
    """The log probability of each word: the sum over its segmentations, by the forward recursion in log space."""
    out = np.zeros(len(words))
    logs = np.r_[v.logs, -np.inf]
    for size, at in _by_length(words):
        if size > LONG:
            out[at] = [_one_word(b" " + words[i], v) for i in at]
            continue
        alpha = np.zeros((size + 1, len(at)))
        for j, lengths, pieces in _lattices([b" " + words[i] for i in at], v):
            alpha[j] = _sum_logs(alpha[[j - n for n in lengths]] + logs[pieces])
        out[at] = alpha[-1]
    return out


def _by_length(words: list[bytes]):
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    order = np.argsort(sizes, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if len(part):
            yield int(sizes[part[0]]), part


def expected_pieces(words: list[bytes], v: Vocabulary) -> np.ndarray:
    """How often each piece is expected in these words, over all segmentations."""
    total = np.zeros(len(v.pieces) + 1)
    logs = np.r_[v.logs, -np.inf]
    for size, at in _by_length(words):
        if size > LONG:
            for i in at:
                _count_pieces(b" " + words[i], v, total)
            continue
        alpha, steps = np.zeros((size + 1, len(at))), []
        for j, lengths, pieces in _lattices([b" " + words[i] for i in at], v):
            alpha[j] = _sum_logs(alpha[[j - n for n in lengths]] + logs[pieces])
            steps.append((j, lengths, pieces))
        beta = np.full((size + 1, len(at)), -np.inf)
        beta[size] = 0.0
        for j, lengths, pieces in reversed(steps):
            through = logs[pieces] + beta[j]
            share = np.exp(alpha[[j - n for n in lengths]] + through - alpha[-1])
            total += np.bincount(pieces.ravel(), share.ravel(), len(total))
            for n, row in zip(lengths, through, strict=True):
                beta[j - n] = np.logaddexp(beta[j - n], row)
    return total[:-1]


def count_words(docs: DataFrame, text: str, learn: str) -> DataFrame:
    """(word, c) for every word of every text; c counts only the texts to learn from, and may be 0."""
    known, others = Counter(), set()

    def told() -> dict | None:
        new = [w for w in others if w not in known]
        out = {"word": [*known, *new], "c": [*known.values(), *([0] * len(new))]}
        known.clear()
        others.clear()
        return out if out["word"] else None

    def count(batch: pa.RecordBatch) -> dict | None:
        for t, training in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            (known if training else others).update(t.lower().split())
        return told() if len(known) + len(others) > TASK_WORDS else None
    return arrow_pass(docs.select(text_bytes(text), F.col(learn)), "word binary, c bigint", count, told).groupBy("word").agg(F.sum("c").alias("c"))


def score_texts(docs: DataFrame, held_out: str, id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lower-cased (A-Z) and split at ASCII white space; each has an end. What is learned comes from rows where
    ``held_out`` is false. ``base_score`` adds the logarithms of the add-one word probabilities. ``score`` is the log10
    of the text's marginal probability: each word, with the space before it, is a lattice of vocabulary pieces (single bytes
    included, so none is impossible) whose segmentations are summed in log space. A word that was learned is one more
    arc across its lattice, weighed by its count less DISCOUNT; what the discounts leave is the weight of the pieces. The end
    follows as a token of its own, so the probabilities of all texts add up to one. The pieces' probabilities start from the
    vocabulary's scores and take the counts expected over all segmentations of all distinct words to learn from.

    Words are counted once over all texts. Words so frequent that there can be only FREQUENT of them are looked up within
    tasks; all others meet their counts in a join by word. Null counts as empty text, which has an end alone; a null id
    stays null; repeated rows stay repeated; an empty table gives no row. Other columns are not looked at.
    """
    kind = docs.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()
    base = docs.select(F.col(id).alias("id"), F.col(held_out).alias("held"), F.col(text).alias("text")).withColumn("learn", ~F.col("held"))
    counts = stored(count_words(base, "text", "learn"))
    texts = base.agg(F.count(F.when(F.col("learn"), 1))).first()[0]
    sums = counts.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    tokens, distinct = (sums[0] or 0) + texts, sums[1] + (1 if texts else 0)
    share = tokens + distinct + 1       # N + 1 * (V + 1)
    start = existing(vocabulary)
    context = docs.sparkSession.sparkContext
    first = context.broadcast(start)
    expected = np.zeros(len(start.pieces))

    def expect(batch: pa.RecordBatch) -> None:
        expected[:] += expected_pieces(batch.column(0).to_pylist(), first.value)

    def all_expected() -> dict:
        at = np.flatnonzero(expected)
        return {"piece": at, "n": expected[at]}
    gathered = arrow_pass(counts.where("c > 0").select("word"), "piece int, n double", expect, all_expected, 1 << 16).groupBy("piece").agg(F.sum("n").alias("n")).collect()
    held = context.broadcast(start.with_counts({r.piece: r.n for r in gathered}))
    types = distinct - (1 if texts else 0)

    def judge(batch: pa.RecordBatch) -> dict:
        c, logs = batch.column(1).to_numpy().astype(float), word_logs(batch.column(0).to_pylist(), held.value)
        rest = DISCOUNT * types + 1.0
        whole = np.log(np.maximum(np.maximum(c - DISCOUNT, 0.0) + rest * np.exp(logs), 1e-300))
        return {"word": batch.column(0), "c": batch.column(1),
                "log": (np.where(c > 0, whole, logs + math.log(rest)) - math.log(tokens + 2.0)) / math.log(10)}
    schema = "word binary, c bigint, log double"
    often = f"c >= {tokens} / {FREQUENT} AND c > 0"
    frequent = arrow_pass(counts.where(often), schema, judge, at_least=1 << 16).collect()
    rare = arrow_pass(counts.where(f"NOT ({often})"), schema, judge, at_least=1 << 16)
    quick = context.broadcast(({bytes(r.word): i for i, r in enumerate(frequent)},
                               np.array([*(math.log10((r.c + 1) / share) for r in frequent), 0.0]), np.array([*(r.log for r in frequent), 0.0])))
    end_base, end_log = math.log10((texts + 1) / share), math.log10((texts + 1) / (tokens + 2.0))

    def look_up(batch: pa.RecordBatch) -> dict:
        index, bases, logs = quick.value
        out = {c: [] for c in ("row", "word", "n", "first", "id", "held", "tokens", "known", "base", "log")}
        for row, key, hold, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = t.lower().split()
            at = np.fromiter(map(index.get, words, itertools.repeat(len(index))), np.int64, len(words))
            left = Counter(w for w, i in zip(words, at.tolist(), strict=True) if i == len(index)) or {b"\n%d" % row: 0}
            k = len(left)
            out["word"] += left
            out["n"] += left.values()
            out["row"] += [row] * k
            out["first"] += [True, *[False] * (k - 1)]
            for name, value in (("id", key), ("held", hold), ("tokens", len(words) + 1), ("known", int((at < len(index)).sum()) + (texts > 0)),
                                ("base", float(bases[at].sum()) + end_base), ("log", float(logs[at].sum()) + end_log)):
                out[name] += [value, *[None] * (k - 1)]
        return out
    looked = arrow_pass(base.select(F.monotonically_increasing_id(), "id", "held", text_bytes("text")),
                        f"row bigint, word binary, n bigint, first boolean, id {kind}, held boolean, tokens bigint, known bigint, base double, log double", look_up)
    met = looked.join(rare.select(F.col("word").alias("w"), "c", F.col("log").alias("word_log")), F.col("word") == F.col("w"), "left")
    n, c = F.col("n"), F.coalesce("c", F.lit(0))
    summed = met.groupBy("row").agg(
        F.max("id").alias("doc_id"), F.max("held").alias("held_out"), F.max("tokens").alias("n_tokens"),
        (F.max("known") + F.sum(F.when(c > 0, n).otherwise(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.max("base") + F.sum(n * F.log10((c + 1) / F.lit(float(share))))).alias("base_score"),
        (F.max("log") + F.sum(n * F.coalesce("word_log", F.lit(0.0)))).alias("score"))
    return summed.drop("row")


@query("op1_subword_lattice")
def op1_subword_lattice(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", remainder("doc_id", 7, 2).alias("held_out"))
    return score_texts(docs, "held_out")
