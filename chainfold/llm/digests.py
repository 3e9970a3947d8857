"""Exact duplicates by a tree-merge of sorted digest runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chainfold.llm.common import query, stored, table

RADIX = 8


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _same(batch: pa.Table, column: str) -> np.ndarray:
    """Which rows repeat the row before them."""
    values = batch.column(column).combine_chunks()
    if column == "digest":
        return np.r_[False, (d := values.to_numpy())[1:] == d[:-1]]
    data = np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(len(values), -1)
    return np.r_[False, (data[1:] == data[:-1]).all(1)]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each digest of a stream in digest order: the smallest id, verified by the full hash, and the count."""
    rest = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        rows = part if rest is None else pa.concat_tables([rest, part])
        starts = np.flatnonzero(~(_same(rows, "digest") & _same(rows, "sha")))
        counts = np.add.reduceat(rows.column("n").to_numpy(), starts)
        at = rows.schema.get_field_index("n")
        merged = rows.take(pa.array(starts)).set_column(at, rows.schema.field(at), pa.array(counts))
        rest = merged.slice(len(merged) - 1)
        yield from merged.slice(0, len(merged) - 1).combine_chunks().to_batches()
    if rest is not None:
        yield from rest.combine_chunks().to_batches()


def _merged(rows: DataFrame) -> DataFrame:
    # nulls last: a row without id only stands for its group if all rows do
    return rows.sortWithinPartitions("digest", "sha", F.col("id").asc_nulls_last()).mapInArrow(_merge, rows.schema)


def smallest_ids(rows: DataFrame) -> DataFrame:
    """(digest, sha, id, n) for each distinct text of (digest, sha, id): the smallest id and the number of rows.

    Each partition sorts its rows into a run. In round r a partition sends each entry of its run to the partner whose
    position has the digest's r-th digit, and every partner merges the runs it gets; after the last round all entries
    of a digest have met, each level having kept one entry per distinct text. Entries are equal if both the 64-bit
    digest and the SHA-256 are, so a digest that collides never joins two texts. A text that a third of all rows hold
    is one entry per partition before the first exchange. Which partition a row starts in does not matter.
    """
    wanted = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rounds = 1
    while RADIX ** rounds < wanted:
        rounds += 1
    size = RADIX ** rounds
    level = _merged(rows.select("digest", "sha", "id", F.lit(1).cast("long").alias("n"),
                                (F.spark_partition_id() % size).alias("place")))
    for r in range(rounds):
        step = RADIX ** r
        digit = lambda value: F.floor(value / step) % RADIX * step  # noqa: B023, E731
        place = (F.col("place") - digit(F.col("place")) + digit(F.pmod("digest", F.lit(size)))).cast("int")
        level = _merged(level.withColumn("place", place).repartition(size, "place"))
    return level.drop("place")


def duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after each run of ASCII whitespace is replaced by one space; null counts as empty. Of
    equal texts the row with the smallest id stays. Rows that repeat both id and text share one decision; so do rows
    without id of a text that no row with an id has (keep_id is then null). An empty table gives no row; other columns are
    not looked at.
    """
    text_sha = F.sha2(normalised(text), 256)
    keyed = stored(docs.select(F.col(id).alias("id"), F.unhex(text_sha).alias("sha")).withColumn("digest", F.xxhash64("sha")))
    groups = smallest_ids(keyed).where("n > 1").select(F.col("sha").alias("s"), F.col("id").alias("keep"), "n")
    found = F.col("n").isNotNull()
    return keyed.join(groups, F.col("sha") == F.col("s"), "left").select(
        F.col("id").alias("doc_id"), F.when(found, F.col("keep")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        F.when(found, F.col("keep").eqNullSafe(F.col("id"))).otherwise(F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


@query("op2_exact_dedup", """WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""")
def op2_exact_dedup(spark, d):
    return duplicates(table(spark, d, "documents"))


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one row for each distinct text, with all their columns. Of repeated rows one stays."""
    sha = F.unhex(F.sha2(normalised(text), 256))
    keyed = stored(docs.select(F.col(id).alias("id"), sha.alias("sha")).withColumn("digest", F.xxhash64("sha")))
    best = smallest_ids(keyed).select(F.xxhash64("sha", "id").alias("__k"), F.col("sha").alias("__s"), F.col("id").alias("__i"))
    marked = docs.withColumn("__sha", sha).withColumn("__key", F.xxhash64("__sha", F.col(id)))
    kept = marked.join(best.hint("shuffle_hash"), (F.col("__key") == F.col("__k")) & (F.col("__sha") == F.col("__s"))
                       & F.col(id).eqNullSafe(F.col("__i")), "left_semi")
    turn = F.row_number().over(Window.partitionBy("__key", "__sha").orderBy(F.lit(1)))
    return kept.withColumn("__turn", turn).where("__turn = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
