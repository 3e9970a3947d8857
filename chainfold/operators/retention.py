"""What may be removed: checkpoints, private generations and source history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def newest_per_account(members: DataFrame) -> DataFrame:
    """Newest checkpoint of each account, from members(snapshot_id, block_number, created_at, address)."""
    best = F.max(F.struct("block_number", "created_at", "snapshot_id")).alias("best")
    return members.groupBy("address").agg(best).select("address", "best.snapshot_id")


def latest_snapshots(ready: DataFrame, keep_latest: int) -> DataFrame:
    if keep_latest < 1:
        raise ValueError("keep_latest must be at least one")
    return ready.orderBy(F.desc("block_number"), F.desc("created_at"), F.desc("snapshot_id")).limit(
        keep_latest).select("snapshot_id")


def retention_plan(ready: DataFrame, members: DataFrame, stored: DataFrame, pins: DataFrame,
                   keep_latest: int) -> DataFrame:
    """One row per snapshot with its action and reason.

    ``ready`` has one row per published snapshot, ``members`` one per snapshot and account. ``stored`` lists every snapshot_id with data, published or not. A pin on a snapshot that is not
    ready gives the action ``stop``: nothing may be removed then.
    """
    flags = {
        "latest": latest_snapshots(ready, keep_latest),
        "newest_for_account": newest_per_account(members).select("snapshot_id").distinct(),
        "pinned": pins.select("snapshot_id").distinct(),
        "ready": ready.select("snapshot_id").distinct(),
        "stored": stored.select("snapshot_id").distinct(),
    }
    rows = None
    for name, frame in flags.items():
        part = frame.select("snapshot_id", F.lit(name).alias("flag"))
        rows = part if rows is None else rows.unionByName(part)
    marks = rows.groupBy("snapshot_id").agg(*[
        F.coalesce(F.max(F.when(F.col("flag") == n, True)), F.lit(False)).alias(n) for n in flags])
    keep = F.col("latest") | F.col("newest_for_account") | F.col("pinned")
    action = F.when(F.col("pinned") & ~F.col("ready"), "stop").when(keep, "keep").otherwise("remove")
    return marks.select("snapshot_id", action.alias("action"), "latest", "newest_for_account", "pinned",
                        (~F.col("ready")).alias("unpublished"))


def history_floor(members: DataFrame, source_accounts: DataFrame) -> DataFrame:
    """Lowest block of any checkpoint that shares an account with the source, and how many do."""
    shared = (members.select("snapshot_id", "block_number", "address")
              .join(source_accounts.select("address").distinct(), "address", "left_semi"))
    return shared.agg(F.min("block_number").alias("floor"), F.countDistinct("snapshot_id").alias("protected"))


def remove_before(floor: int, tip: int, keep_blocks: int) -> int:
    if keep_blocks < 1:
        raise ValueError("keep_blocks must be at least one")
    if tip < floor:
        raise ValueError("progress has not reached the checkpoint")
    return min(floor + 1, max(tip - (keep_blocks - 1), 0))


def partition_bounds(blocks: DataFrame, partition: str) -> DataFrame:
    return blocks.groupBy(partition).agg(F.min("number").alias("first"), F.max("number").alias("last"))


def partitions_before(blocks: DataFrame, partition: str, before: int) -> DataFrame:
    """Whole partitions that end below the bound."""
    return partition_bounds(blocks, partition).where(F.col("last") < before)


def generations_to_drop(stored: DataFrame, current: DataFrame) -> DataFrame:
    return stored.select("generation").distinct().join(current.select("generation"), "generation", "left_anti")


def already_published(accounts: DataFrame, members: DataFrame) -> DataFrame:
    """Accounts that have a checkpoint already and must not start privately again."""
    published = members.select("address").distinct()
    return accounts.select("address").distinct().join(published, "address", "left_semi")


def pins_report(pins: DataFrame) -> DataFrame:
    return pins.orderBy("created_at", "pin_id")
