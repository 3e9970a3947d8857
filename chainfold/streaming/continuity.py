"""Continuity across micro-batches: the last block of each source is carried from batch to batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainfold.operators.continuity import last_blocks, link_defects
from chainfold.sources import folders


def watch_continuity(spark: SparkSession, blocks: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Defects of a stream(source, number, hash, parent_hash): gaps, repeats, late and unlinked blocks.

    Each batch is stored and checked as a table of the caller's session: a stream's own session plans
    without AQE, which the joins need to split a busy source. A repeated batch rewrites its folders.
    """
    none = spark.createDataFrame([], "source string, number bigint, hash string")

    def check(batch: DataFrame, batch_id: int) -> None:
        older = [int(v) for v in folders.partition_values(spark, f"{path}/last", "batch") if int(v) < batch_id]
        last = spark.read.schema(none.schema).parquet(f"{path}/last/batch={max(older)}") if older else none
        rows = f"{path}/rows/batch={batch_id}"
        batch.select("source", "number", "hash", "parent_hash").write.mode("overwrite").parquet(rows)
        stored = spark.read.parquet(rows)
        link_defects(stored, last).write.mode("overwrite").parquet(f"{path}/defects/batch={batch_id}")
        last_blocks(stored, last).write.mode("overwrite").parquet(f"{path}/last/batch={batch_id}")
        folders.delete(spark, rows)

    (blocks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(check)
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.option("basePath", f"{path}/defects").parquet(f"{path}/defects").drop("batch")
