"""Prune checkpoints and covered source history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.operators import retention as R
from chainfold.plans import store
from chainfold.sources import folders


def retention_plan(spark: SparkSession, root: str, keep_latest: int) -> DataFrame:
    ready = store.ready_checkpoints(spark, root).select("snapshot_id", "block_number", "created_at")
    return R.retention_plan(ready, store.checkpoint_members(spark, root), store.stored_snapshots(spark, root),
                            store.pins(spark, root), keep_latest)


def prune_checkpoints(spark: SparkSession, root: str, keep_latest: int) -> list[str]:
    """Remove what the plan allows. The manifest goes first: an interrupted prune leaves a candidate,
    never a readable half."""
    plan = retention_plan(spark, root, keep_latest).select("snapshot_id", "action").collect()   # one row per snapshot
    if any(row["action"] == "stop" for row in plan):
        raise ValueError("a pinned checkpoint is missing; nothing was removed")
    gone = sorted(row["snapshot_id"] for row in plan if row["action"] == "remove")
    for snapshot_id in gone:
        for table in (store.MANIFESTS, store.ACCOUNTS, store.INDEX, store.STORAGE):
            folders.delete(spark, store.part(root, table, "snapshot_id", snapshot_id))
    return gone


def history_plan(spark: SparkSession, root: str, history: str, accounts: DataFrame, keep_blocks: int,
                 partition: str = "block_date") -> dict:
    """Whole partitions of an envelope table that all kept checkpoints and the newest blocks can spare."""
    floor = R.history_floor(store.checkpoint_members(spark, root), accounts).first()
    if floor["floor"] is None:
        raise ValueError("no checkpoint covers this source")
    blocks = spark.read.parquet(history).select("number", F.col(partition).cast("string").alias(partition))
    before = R.remove_before(floor["floor"], blocks.agg(F.max("number")).first()[0], keep_blocks)
    parts = [row.asDict() for row in R.partitions_before(blocks, partition, before).orderBy("first").collect()]
    return {"remove_before": before, "protected_checkpoints": floor["protected"], "partitions": parts}


def prune_history(spark: SparkSession, root: str, history: str, accounts: DataFrame, keep_blocks: int,
                  partition: str = "block_date") -> dict:
    plan = history_plan(spark, root, history, accounts, keep_blocks, partition)
    for part in plan["partitions"]:
        folders.delete(spark, f"{history}/{partition}={part[partition]}")
    return {**plan, "applied": True}
