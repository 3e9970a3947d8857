"""Where checkpoints, private generations and pins live.

A table is a folder of ``key=value`` partitions. A version becomes visible when its one-row manifest
is written, which always happens last; readers start from manifests only. Nothing is overwritten.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold import schema as S
from chainfold.sources import folders

STORAGE, ACCOUNTS, MANIFESTS, PINS = "checkpoint_storage", "checkpoint_accounts", "checkpoints", "pins"
INDEX = "checkpoint_index"
GENERATIONS, PREFIX_STORAGE, PREFIX_FIELDS = "generations", "prefix_storage", "prefix_fields"
MANIFEST = "snapshot_id string, block_number bigint, block_hash string, created_at bigint, manifest string"
GENERATION = "generation string, number bigint, manifest string"
PIN = "pin_id string, snapshot_id string, created_at bigint, purpose string"
INDEX_ROW = "address string, file string, rows bigint, first_slot string, last_slot string"
FIELDS = "address string, balance string, nonce decimal(20,0), code_hash string, code string"


def new_id() -> str:
    return uuid.uuid4().hex


def now_ns() -> int:
    return time.time_ns()


def part(root: str, table: str, key: str, value: str) -> str:
    return f"{root}/{table}/{key}={value}"


def write_sorted(state: DataFrame, path: str) -> None:
    """Slots in key order over range partitions: a page then reads few row groups."""
    (state.select("address", "slot", "value").repartitionByRange("address", "slot")
     .sortWithinPartitions("address", "slot").write.mode("errorifexists").parquet(path))


def write_index(spark: SparkSession, root: str, snapshot_id: str) -> None:
    """Which file holds which slots of which account: about one row per account plus one per file."""
    files = snapshot_storage(spark, root, snapshot_id).groupBy("address", F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    (files.repartitionByRange("address", "first_slot").sortWithinPartitions("address", "first_slot")
     .write.mode("errorifexists").parquet(part(root, INDEX, "snapshot_id", snapshot_id)))


def page_storage(spark: SparkSession, root: str, snapshot_id: str, address: str, after: str, limit: int) -> DataFrame:
    """Only the files that can hold the ``limit`` slots behind ``after``, however large the account is."""
    index = spark.read.schema(INDEX_ROW).parquet(part(root, INDEX, "snapshot_id", snapshot_id))
    # Every file behind the first gives at least one slot, so limit + 1 files are always enough.
    ahead = (index.where((F.col("address") == address) & (F.col("last_slot") > after))
             .orderBy("first_slot").limit(limit + 1).collect())
    chosen, sure = [], 0
    for row in ahead:
        if sure >= limit:
            break
        chosen.append(row["file"])
        sure += row["rows"] if row["first_slot"] > after else 0
    if not chosen:
        return spark.createDataFrame([], S.CHECKPOINT_STORAGE)
    return spark.read.schema(S.CHECKPOINT_STORAGE).parquet(*chosen)


def write_row(spark: SparkSession, path: str, row: tuple, schema: str) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("errorifexists").parquet(path)


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


# ---------------------------------------------------------------- reads

def snapshot_storage(spark: SparkSession, root: str, snapshot_id: str) -> DataFrame:
    """One partition folder, found without listing the others."""
    return spark.read.schema(S.CHECKPOINT_STORAGE).parquet(part(root, STORAGE, "snapshot_id", snapshot_id))


def snapshot_accounts(spark: SparkSession, root: str, snapshot_id: str) -> DataFrame:
    return spark.read.schema(S.CHECKPOINT_ACCOUNT).parquet(part(root, ACCOUNTS, "snapshot_id", snapshot_id))


def _rows(spark: SparkSession, root: str, table: str, key: str, schema: str) -> DataFrame:
    if not folders.partition_values(spark, f"{root}/{table}", key):
        return spark.createDataFrame([], schema)
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    typed = ", ".join(part for part in schema.split(", ") if not part.startswith(key + " "))
    return (spark.read.option("basePath", f"{root}/{table}").schema(f"{typed}, {key} string")
            .parquet(f"{root}/{table}").select(*names))


def ready_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """Published checkpoints, newest first."""
    return _rows(spark, root, MANIFESTS, "snapshot_id", MANIFEST).orderBy(
        F.desc("block_number"), F.desc("created_at"))


def checkpoint_members(spark: SparkSession, root: str) -> DataFrame:
    """Accounts of every published checkpoint, one row each."""
    ready = ready_checkpoints(spark, root).select("snapshot_id", "block_number", "created_at")
    if not folders.partition_values(spark, f"{root}/{ACCOUNTS}", "snapshot_id"):
        return ready.withColumn("address", F.lit(None).cast("string")).limit(0)
    stored = spark.read.option("basePath", f"{root}/{ACCOUNTS}").schema("address string, snapshot_id string").parquet(
        f"{root}/{ACCOUNTS}")
    return stored.join(ready, "snapshot_id")


def stored_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Every snapshot with any data, published or not, from folder names."""
    found = sorted({v for t in (STORAGE, ACCOUNTS, MANIFESTS)
                    for v in folders.partition_values(spark, f"{root}/{t}", "snapshot_id")})
    return spark.createDataFrame([(v,) for v in found], "snapshot_id string")


def manifest(spark: SparkSession, root: str, snapshot_id: str) -> dict:
    path = part(root, MANIFESTS, "snapshot_id", snapshot_id)
    if not folders.written(spark, path):
        raise LookupError(f"checkpoint {snapshot_id} is not published")
    value = json.loads(spark.read.parquet(path).select("manifest").first()[0])
    if value.get("snapshot_id") != snapshot_id or value.get("status") != "ready":
        raise ValueError("checkpoint has no valid ready manifest")
    return value


def pins(spark: SparkSession, root: str) -> DataFrame:
    return _rows(spark, root, PINS, "pin_id", PIN).orderBy("created_at")


def current_generation(spark: SparkSession, folder: str) -> dict | None:
    """Manifest of the newest committed private generation."""
    newest = _rows(spark, folder, GENERATIONS, "generation", GENERATION).orderBy(
        F.desc("number"), F.desc("generation")).first()
    return None if newest is None else json.loads(newest["manifest"])


def generation_storage(spark: SparkSession, folder: str, generation: str) -> DataFrame:
    return spark.read.schema(S.CHECKPOINT_STORAGE).parquet(part(folder, PREFIX_STORAGE, "generation", generation))


def generation_fields(spark: SparkSession, folder: str, generation: str) -> DataFrame:
    return spark.read.schema(FIELDS).parquet(part(folder, PREFIX_FIELDS, "generation", generation))
