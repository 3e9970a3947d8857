"""State kept by a stream in bucketed tables: a fold moves the new rows to the state, never the state to them.

The folded prefix is a table bucketed and sorted by (address, slot). A batch stores its own reduced rows; every few batches
they are joined to the prefix, which stays where it is: its scan already has the partitioning that the join asks for.
A reset is a row with an empty slot, so one table holds all that is kept. Folders are named by batch, which makes a
repeated batch write the same rows; a folder counts once Spark has marked it as written whole.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.operators import latest as L
from chainfold.sources import folders

ROWS = "address string, slot string, number bigint, ordinal bigint, value string"
KEYS = ["address", "slot"]
BUCKETS, FOLD_EVERY = 16, 16


def _table(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The bucketed files at ``path`` as a table, whichever session wrote them."""
    name = f"prefix_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({ROWS}) USING parquet CLUSTERED BY ({', '.join(KEYS)}) SORTED BY ({', '.join(KEYS)}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _written(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(batch, buckets) of the folders that were written whole; deltas have no buckets."""
    found = []
    for name in folders.partition_values(spark, path, "batch"):
        if folders.exists(spark, f"{path}/batch={name}/_SUCCESS"):
            batch, _, buckets = name.partition("-")
            found.append((int(batch), int(buckets or 0)))
    return sorted(found)


def _newest(spark: SparkSession, path: str) -> tuple[DataFrame | None, int, int, list[int]]:
    """The newest prefix, its batch and buckets, and the batches behind it."""
    prefixes, deltas = _written(spark, f"{path}/prefix"), [b for b, _ in _written(spark, f"{path}/delta")]
    if not prefixes:
        return None, -1, 0, deltas
    batch, buckets = prefixes[-1]
    return _table(spark, f"{path}/prefix/batch={batch}-{buckets}", buckets), batch, buckets, [b for b in deltas if b > batch]


def _deltas(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    rows = spark.read.schema(ROWS).parquet(*[f"{path}/delta/batch={b}" for b in batches])
    return L.latest_slots(rows)


def folded(prefix: DataFrame | None, deltas: DataFrame | None) -> DataFrame:
    """The newest row of each key of both; only the deltas are exchanged."""
    if prefix is None or deltas is None:
        return prefix if deltas is None else deltas
    old, new = prefix.alias("old"), deltas.alias("new")
    at = lambda side: F.struct(f"{side}.number", f"{side}.ordinal", f"{side}.value")
    both = old.join(new, KEYS, "full")
    best = F.greatest(F.when(F.col("old.number").isNotNull(), at("old")), F.when(F.col("new.number").isNotNull(), at("new")))
    return both.select(*KEYS, best.alias("best")).select(*KEYS, "best.number", "best.ordinal", "best.value")


def fold(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """Make a new prefix of the newest one and all batches behind it; the number of buckets is the first prefix's."""
    prefix, _, held, behind = _newest(spark, path)
    if not behind:
        return
    buckets, target = held or buckets, f"{path}/prefix/batch={behind[-1]}-{held or buckets}"
    rows = folded(prefix, _deltas(spark, path, behind))
    if prefix is None:
        rows = rows.repartition(buckets, *KEYS)
    name = f"prefix_{hashlib.sha256(target.encode()).hexdigest()[:24]}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (rows.select("address", "slot", "number", "ordinal", "value").write.mode("overwrite").bucketBy(buckets, *KEYS).sortBy(*KEYS)
     .option("path", target).saveAsTable(name))
    # the folders just folded stay for readers that chose them; older ones go
    for batch, _ in _written(spark, f"{path}/delta"):
        if batch < behind[0]:
            folders.delete(spark, f"{path}/delta/batch={batch}")
    for batch, n in _written(spark, f"{path}/prefix")[:-2]:
        folders.delete(spark, f"{path}/prefix/batch={batch}-{n}")


def state(spark: SparkSession, path: str) -> DataFrame | None:
    """Nonzero state after resets of all that was stored, or None before the first batch."""
    prefix, _, _, behind = _newest(spark, path)
    rows = folded(prefix, _deltas(spark, path, behind) if behind else None)
    if rows is None:
        return None
    resets = rows.where("slot = ''").select("number", "ordinal", "address")
    return L.nonzero(L.after_resets(rows.where("slot <> ''"), resets))


def fold_changes(spark: SparkSession, changes: DataFrame, resets_of: str, path: str, checkpoint: str,
                 fold_every: int = FOLD_EVERY, buckets: int = BUCKETS) -> DataFrame:
    """Fold a flat change stream(number, ordinal, address, slot, value, kind) and return its state.

    Positions stay in the rows, so a change that arrives late cannot win. Rows of kind ``resets_of`` reset their account.
    """
    reset = F.col("kind") == resets_of

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("address", F.when(reset, "").otherwise(F.col("slot")).alias("slot"), "number", "ordinal",
                            F.when(~reset, F.col("value")).alias("value"))
        L.latest_slots(rows).write.mode("overwrite").parquet(f"{path}/delta/batch={batch_id}")
        if (batch_id + 1) % fold_every == 0:
            fold(spark, path, buckets)

    (changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
     .trigger(availableNow=True).start().awaitTermination())
    found = state(spark, path)
    if found is None:
        raise LookupError("the stream held no changes")
    return found
