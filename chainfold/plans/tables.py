"""All relational tables of a block stream, and their idempotent storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.functions import scalars as X
from chainfold.operators import current_state as C, persistence as P
from chainfold.sources.blocks import resolve_retries

LOG_KEYS = {name: ["block_num", "ordinal"] for name in C.LOGS}
LOG_KEYS["set_code_authorizations"] = ["block_num", "tx_hash", "auth_index"]
_KIND_OF = {"storage_changes": "storage", "balance_changes": "balances", "nonce_changes": "nonces", "code_changes": "codes"}


def project_tables(blocks: DataFrame, accounts: str = "") -> dict[str, DataFrame]:
    """Block rows, the five logs, and this batch's part of the current-state tables."""
    persisted = P.persisted_blocks(blocks, accounts)
    changes = {kind: P.changes_of(persisted, kind) for kind in _KIND_OF.values()}
    authorizations = persisted.select("number", F.col("hash").alias("block_hash"), "timestamp", F.inline("authorizations"))
    named = {kind: rows.withColumn("address", X.hex_text("address")) for kind, rows in changes.items()}
    storage = named["storage"].select("number", "ordinal", "place", "address", X.word("key").alias("slot"),
                                      X.word("new_value").alias("value"))
    codes = named["codes"].withColumn("new_hash", X.hex_text("new_hash"))
    tables = {log: C.event_log(persisted, kind, changes[kind]) for log, kind in _KIND_OF.items()}
    tables["set_code_authorizations"] = C.authorization_log(authorizations)
    tables["blocks"] = C.block_rows(persisted)
    tables["storage"] = C.current_storage(storage)
    tables["accounts"] = C.current_accounts(named["balances"], named["nonces"], codes)
    tables["code"] = C.distinct_code(codes)
    return tables


def append_log(rows: DataFrame, path: str, batch_id: int, step: int) -> None:
    """One folder per batch, range partitions of ``step`` blocks inside; a repeated batch replaces itself."""
    (rows.withColumn("block_bucket", C.block_bucket(step, "block_num"))
     .repartition("block_bucket", F.expr(f"block_num div {max(step // 64, 1)}"))
     .sortWithinPartitions("block_bucket", "block_num").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("block_bucket").parquet(f"{path}/batch={batch_id}"))


def read_log_table(spark: SparkSession, path: str, log: str, first: int | None = None, last: int | None = None,
                   step: int | None = None) -> DataFrame:
    """A log by block range. The bucket bound prunes folders, the block bound row groups; a key
    delivered by two batches keeps the later one."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    if first is not None:
        rows = rows.where(F.col("block_num") >= first)
        rows = rows.where(F.col("block_bucket") >= first - first % step) if step else rows
    if last is not None:
        rows = rows.where(F.col("block_num") <= last)
        rows = rows.where(F.col("block_bucket") <= last) if step else rows
    keyed = rows.withColumn("_version_", F.col("batch").cast("bigint")).withColumn("_deleted_", F.lit(False))
    return resolve_retries(keyed.drop("batch"), tuple(LOG_KEYS[log]))
