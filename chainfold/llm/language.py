"""Language identification by n-gram filters whose cells hold a bit per language."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chainfold.llm.common import MIX, arrow_pass, mix, query, remainder, table

N = 3
HASHES = 3
BITS = 17               # the filter has 2 ** BITS cells
SHARE = 0.25            # an n-gram belongs to a language if it is that frequent, against where it is most frequent
LEAST = 2               # and was seen so often there
SLICE = 1 << 18
UNKNOWN = "und"

_letters = np.zeros(0x110000, bool)
_lower = np.arange(0x110000, dtype=np.uint32)


def _tables() -> None:
    """Which code points are letters, and their lower case."""
    if not _letters[97]:
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] == "L":
                _letters[c] = True
                low = chr(c).lower()
                if len(low) == 1:
                    _lower[c] = ord(low)


def ngrams(text: str) -> np.ndarray:
    """All n-grams of a text's words as exact numbers, 21 bits a character; word borders are spaces."""
    _tables()
    found = []
    for at in range(0, len(text), SLICE):
        codes = np.frombuffer(text[max(0, at - N + 1):at + SLICE].encode("utf-32-le", "replace"), np.uint32)
        codes = np.where(_letters[codes], _lower[codes], np.uint32(32))
        codes = np.r_[np.uint32(32), codes, np.uint32(32)] if len(text) <= SLICE else codes
        codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]].astype(np.uint64)
        value = codes[:max(0, len(codes) - N + 1)]
        for i in range(1, N):
            value = (value << np.uint64(21)) | codes[i:len(codes) - N + 1 + i]
        found.append(value)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def has_letter(text: str) -> bool:
    return text.isascii() and any(map(str.isalpha, text)) or any(map(str.isalpha, text))


def cells(grams: np.ndarray) -> np.ndarray:
    """The filter's cells of each n-gram, a row per hash function."""
    h = mix(grams + MIX)
    one, two = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(one + np.uint64(i) * two) & np.uint64((1 << BITS) - 1) for i in range(HASHES)]).astype(np.int64)


def count_ngrams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over whole texts: each batch counts before the shuffle."""
    def count(batch: pa.RecordBatch) -> dict:
        by: dict[str, list] = {}
        for t, l in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by.setdefault(l, []).append(ngrams(t))
        out = {"lang": [], "gram": [], "n": []}
        for l, parts in by.items():
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            out["lang"] += [l] * len(gram)
            out["gram"].append(gram.view(np.int64))
            out["n"].append(n)
        return {"lang": out["lang"], "gram": np.concatenate(out["gram"]), "n": np.concatenate(out["n"])} if by else None
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text), F.col(lang).cast("string"))
    return arrow_pass(rows, "lang string, gram bigint, n bigint", count).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """The filter: per cell a mask of languages. ``fill`` is the share of cells that a language has set."""

    def __init__(self, langs: list[str], masks: np.ndarray):
        self.langs, self.masks = langs, masks
        bits = np.arange(len(langs), dtype=np.uint64)
        self.fill = np.array([np.count_nonzero(masks >> b & np.uint64(1)) for b in bits]) / len(masks)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the corrected counts; und and 0 where there is no letter or no language."""
        if not text or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        hits, n = np.zeros(len(self.langs)), 0
        for at in range(0, len(text), SLICE):
            grams = ngrams(text[at:at + SLICE])
            held = np.bitwise_and.reduce(self.masks[cells(grams)], axis=0)
            n += len(grams)
            for b in range(len(self.langs)):
                hits[b] += np.count_nonzero(held >> np.uint64(b) & np.uint64(1))
        false = self.fill ** HASHES     # chance that an n-gram outside a language seems to be in it
        real = np.maximum(0.0, (hits - n * false) / np.maximum(1e-9, 1 - false))
        best = int(np.argmax(real))
        return self.langs[best], float(real[best] / max(1e-9, real.sum())) if real.sum() > 0 else 0.0


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Build the filters from labelled documents; what comes to the driver is at most 2 ** BITS cells, whatever the corpus.

    An n-gram is put in for each language where its relative frequency is at least SHARE of its highest over languages,
    so single foreign words in a text do not spoil a language. At most 64 languages. Null texts and languages are left out.
    """
    counts = count_ngrams(docs, text, lang).persist()
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").limit(65).collect()}
    langs = sorted(totals)
    if len(langs) > 64:
        raise ValueError("a cell has room for 64 languages")
    masks = np.zeros(1 << BITS, np.uint64)
    if langs:
        rate, bit = F.lit(0.0), F.lit(0).cast("long")
        for i, l in enumerate(langs):
            rate = F.when(F.col("lang") == l, F.col("n") / F.lit(float(totals[l]))).otherwise(rate)
            bit = F.when(F.col("lang") == l, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(bit)
        rated = counts.select("gram", "n", rate.alias("rate"), bit.alias("bit"))
        best = rated.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("rate", "n", "bit")).alias("each"))
        mask = F.aggregate(F.filter("each", lambda e: (e.rate >= F.col("top") * SHARE) & (e.n >= LEAST)),
                           F.lit(0).cast("long"), lambda a, e: a.bitwiseOR(e.bit))
        kept = best.select("gram", mask.alias("mask")).where("mask != 0")

        def place(batch: pa.RecordBatch) -> dict:
            at = cells(batch.column(0).to_numpy().view(np.uint64))
            return {"cell": at.ravel(), "mask": np.tile(batch.column(1).to_numpy(), HASHES)}
        for row in arrow_pass(kept, "cell bigint, mask bigint", place).groupBy("cell").agg(F.bit_or("mask").alias("mask")).collect():
            masks[row.cell] = np.uint64(row.mask & 0xFFFFFFFFFFFFFFFF)
    counts.unpersist()
    return Filters(langs, masks)


def identify(docs: DataFrame, filters: Filters, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row, from the whole text alone.

    A null text or one without a letter gives und with score 0, as does a model that has seen no language. Repeated rows
    stay repeated, ties go to the first language in alphabetical order, and an empty table gives no row.
    """
    held = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([held.value.predict(t) for t in texts], columns=["lang_pred", "score"])
    guess = F.pandas_udf(predict, "lang_pred string, score double")
    return docs.select(F.col(id).alias("doc_id"), guess(F.col(text)).alias("guess")).select("doc_id", "guess.*")


@query("op5_language_filters")
def op5_language_filters(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", remainder("doc_id", 3, 1).alias("held_out"))
    filters = fit(docs.where("NOT held_out"))
    return identify(docs, filters).withColumn("held_out", remainder("doc_id", 3, 1)).select("doc_id", "held_out", "lang_pred", "score")
