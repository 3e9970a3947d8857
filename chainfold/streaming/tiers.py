"""State kept by a stream as one full table plus small deltas.

A micro-batch writes only its own reduced rows. Every few batches the deltas are merged into a new
full table, so the cost of rewriting the state is shared by all of them. Folders are named by batch,
which makes a repeated batch write the same rows, and a folder counts only once its marker is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainfold.sources import folders

Tables = dict[str, DataFrame]
MERGE_EVERY = 8


def _complete(spark: SparkSession, folder: str, tier: str) -> list[int]:
    ids = sorted(int(v) for v in folders.partition_values(spark, f"{folder}/{tier}", "batch"))
    return [i for i in ids if folders.written(spark, f"{folder}/{tier}/batch={i}/done")]


def _write(spark: SparkSession, path: str, tables: Tables) -> None:
    folders.delete(spark, f"{path}/done")
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/done")


def parts(spark: SparkSession, folder: str, upto: int | None = None) -> list[str]:
    """Folders that together are the state: the newest full table and the deltas behind it."""
    full = [i for i in _complete(spark, folder, "full") if upto is None or i <= upto]
    deltas = [i for i in _complete(spark, folder, "delta") if upto is None or i <= upto]
    start = max(full) if full else None
    found = [f"{folder}/full/batch={start}"] if full else []
    return found + [f"{folder}/delta/batch={i}" for i in deltas if start is None or i > start]


def load(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    rows = spark.read.parquet(f"{paths[0]}/{name}")
    for path in paths[1:]:
        rows = rows.unionByName(spark.read.parquet(f"{path}/{name}"))
    return rows


def append(spark: SparkSession, folder: str, batch_id: int, reduced: Tables, merge: Callable[[Tables], Tables],
           merge_every: int = MERGE_EVERY) -> None:
    """Store one batch; merge when enough deltas have gathered. ``merge`` must not depend on order."""
    if batch_id in _complete(spark, folder, "full"):
        return
    _write(spark, f"{folder}/delta/batch={batch_id}", reduced)
    current = parts(spark, folder, batch_id)
    if len([p for p in current if "/delta/" in p]) < merge_every:
        return
    _write(spark, f"{folder}/full/batch={batch_id}", merge({name: load(spark, current, name) for name in reduced}))
    # The folders just merged stay for readers that chose them; older ones go.
    for tier in ("full", "delta"):
        for old in folders.partition_values(spark, f"{folder}/{tier}", "batch"):
            path = f"{folder}/{tier}/batch={old}"
            if int(old) < batch_id and path not in current:
                folders.delete(spark, path)


def state(spark: SparkSession, folder: str, names: list[str], merge: Callable[[Tables], Tables]) -> Tables | None:
    """All tables as of one common batch, or None before the first."""
    chosen = parts(spark, folder)
    return merge({name: load(spark, chosen, name) for name in names}) if chosen else None
