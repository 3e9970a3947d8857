"""What the operators of this package share: tables, Arrow passes, stored intermediate rows."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chainfold.session import shared_folder, ship

QUERIES: dict = {}
SQL: dict[str, str] = {}

SPACES = bytes((0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, the SQL with the same result."""
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register


BATCH_BYTES = str(8 << 20)      # of an Arrow batch, so that long texts do not add up in a task


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(rows: DataFrame) -> DataFrame:
    """Write rows as Parquet to the shared folder and read them back: what a lost executor held is never computed anew."""
    folder = f"{shared_folder(rows.sparkSession)}/llm-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def text_bytes(text: str) -> Column:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def without(docs: DataFrame, mark: Column, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose mark is not in ``gone`` (one column), with their own columns, whatever these are called."""
    name = gone.columns[0]
    rows = docs.select(mark.alias("mark"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return rows.join(gone.select(F.col(name).alias("gone")), F.col("mark") == F.col("gone"), "left_anti").select("doc.*")


def remainder(key: str, divisor: int, value: int) -> Column:
    """crc32 of the key as text, modulo; false where the key is null."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % divisor == value, F.lit(False))


def arrow_pass(rows: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict | None],
               flush: Callable[[], dict | None] | None = None, at_least: int = 1) -> DataFrame:
    """Run ``work`` on each Arrow batch; it gives the columns of the result. ``flush`` gives what is left at the end.

    Batches are put together until they have ``at_least`` so many rows.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = to_arrow_schema(_parse_datatype_string(schema))

    def batch(columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in kind], schema=kind)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for one in batches:
            held.append(one)
            rows += one.num_rows
            if rows >= at_least:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in together(batches):
            if (out := work(one)) is not None:
                yield batch(out)
        if flush is not None and (out := flush()) is not None:
            yield batch(out)
    return rows.mapInArrow(run, schema)


MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0x100000001B3)
SLICE = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


_powers: list[np.ndarray] = []


def powers() -> list[np.ndarray]:
    """STEP ** i and its inverse modulo 2 ** 64, for one slice."""
    if not _powers:
        for base in (STEP, np.uint64(pow(int(STEP), -1, 1 << 64))):
            factor = np.full(SLICE + 1, base, np.uint64)
            factor[0] = 1
            _powers.append(np.cumprod(factor, dtype=np.uint64))
    return _powers


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each whitespace-separated word of a text, A-Z as a-z, without making word objects.

    Longer texts are hashed in slices cut between words, so that memory beside the result stays bounded; a single
    word longer than a slice is hashed on its own.
    """
    return words_and_lines(text)[0]


def words_and_lines(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word and the number of line ends before it."""
    out, lines, at, passed = [], [], 0, 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            end = max(text.rfind(bytes((s,)), at, end) for s in SPACES)
            if end <= at:
                end = min((p for s in SPACES if (p := text.find(bytes((s,)), at + 1)) > 0), default=len(text))
        piece = text[at:end].lower()
        at = end
        if len(piece) > SLICE and (word := piece.strip()):
            found = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64), np.array([piece[:piece.find(word)].count(b"\n")])
        else:
            found = _hash_slice(piece)
        out.append(found[0])
        lines.append(found[1] + passed)
        passed += piece.count(b"\n")
    return (np.concatenate(out), np.concatenate(lines)) if out else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _hash_slice(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers()
    data = np.frombuffer(text, np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    hashed = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashed, np.searchsorted(np.flatnonzero(data == 10), starts)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    width = min(width, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        out = out * STEP + words[i:len(words) - width + 1 + i]
    return mix(out)
