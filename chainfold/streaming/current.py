"""Current-state tables kept by a stream: partial upserts that never lose a field or a newer block."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.operators import current_state as C
from chainfold.sources import folders
from chainfold.streaming import tiers

TABLES = ["storage", "accounts", "head"]


def _merge(tables: tiers.Tables) -> tiers.Tables:
    return {"storage": C.newest_storage(tables["storage"]), "accounts": C.newest_accounts(tables["accounts"]),
            "head": tables["head"].orderBy(F.desc("number")).limit(1)}


def merge_batch(spark: SparkSession, folder: str, batch_id: int, storage: DataFrame, accounts: DataFrame,
                head: DataFrame, merge_every: int = tiers.MERGE_EVERY) -> None:
    """Add a batch of reduced rows. ``head`` has block_num, number, hash and state_root of its newest block."""
    tiers.append(spark, folder, batch_id, {"storage": storage, "accounts": accounts, "head": head}, _merge, merge_every)


def reduce_batch(spark: SparkSession, folder: str, batch_id: int, batch: DataFrame,
                 reduce: Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]], merge_every: int = tiers.MERGE_EVERY) -> None:
    """Add a batch of raw rows, which ``reduce`` turns into storage, accounts and head.

    The batch is stored once and reduced as a table of the caller's session: a stream's own session would compute the whole
    batch for each of the three, and plans without AQE, so with as many tasks and files as there are shuffle partitions.
    """
    rows = f"{folder}/rows/batch={batch_id}"
    batch.write.mode("overwrite").parquet(rows)
    merge_batch(spark, folder, batch_id, *reduce(spark.read.schema(batch.schema).parquet(rows)), merge_every)
    folders.delete(spark, rows)


def read_current(spark: SparkSession, folder: str) -> tiers.Tables:
    """Head, accounts and storage of one and the same batch."""
    found = tiers.state(spark, folder, TABLES, _merge)
    if found is None:
        raise LookupError("no current state yet")
    return found
