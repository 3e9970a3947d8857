"""Follow finalized blocks: bounded, resumable, idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from chainfold import schema as S
from chainfold.functions import scalars as X
from chainfold.operators.continuity import check_range
from chainfold.sources import folders
from chainfold.sources.blocks import resolve_retries

TIP = "finalized_number"


def stream_files(spark: SparkSession, path: str, schema: StructType, form: str = "parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """File stream with the declared schema."""
    reader = spark.readStream.schema(schema).format(form)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def finalized(blocks: DataFrame, start: int, stop: int | None = None, tip: str = TIP) -> DataFrame:
    """Blocks of ``[start, stop)`` that the source has declared final."""
    rows = blocks.where((F.col("number") >= start) & (F.col("number") <= F.col(tip))) if tip in blocks.columns \
        else blocks.where(F.col("number") >= start)
    return rows if stop is None else rows.where(F.col("number") <= check_range(start, stop)[1])


def append_envelopes(batch: DataFrame, path: str, batch_id: int) -> None:
    """Daily partitions sorted by (number, hash); one folder per batch makes a repeat harmless."""
    dated = batch.dropDuplicates(["number", "hash"]).withColumn("block_date", X.day_partition("timestamp").cast("string"))
    (dated.repartition("block_date", F.expr("number div 10000")).sortWithinPartitions("block_date", "number", "hash")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("block_date")
     .parquet(f"{path}/batch={batch_id}"))


def ask(spark: SparkSession, path: str, start: int, stop: int | None) -> None:
    """Note that the table at ``path`` is to show ``[start, stop)``; a table shows the union of what was asked for so far."""
    bounds = spark.createDataFrame([(start, stop)], "start bigint, stop bigint").coalesce(1)
    bounds.write.mode("overwrite").parquet(f"{path}/bounds/from={start}/to={'open' if stop is None else stop}")


def asked_ranges(spark: SparkSession, path: str) -> list[tuple[int, int | None]]:
    """The union of all ranges asked for, as few ranges as it takes; one row per call is read."""
    bounds = spark.read.schema("start bigint, stop bigint").parquet(f"{path}/bounds").select("start", "stop").collect()
    merged: list[tuple[int, int | None]] = []
    for start, stop in sorted(bounds, key=lambda b: b["start"]):
        if merged and (merged[-1][1] is None or start <= merged[-1][1]):
            last = merged[-1][1]
            merged[-1] = (merged[-1][0], None if last is None or stop is None else max(last, stop))
        else:
            merged.append((start, stop))
    return merged


def visible(spark: SparkSession, path: str) -> DataFrame:
    """The stored blocks that were asked for and are final, each with its batch.

    Every block that arrived is stored. One that came before the source called it final shows as soon as any later
    row proves it, and one beyond the stop as soon as a later stop is asked for.
    """
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    if folders.exists(spark, f"{path}/bounds"):
        shown = F.lit(False)
        for start, stop in asked_ranges(spark, path):
            inside = F.col("number") >= start
            shown = shown | (inside if stop is None else inside & (F.col("number") < stop))
        rows = rows.where(shown)
    if TIP in rows.columns:
        tip = rows.agg(F.max(TIP)).first()[0]
        rows = rows.where(F.col("number") <= F.lit(tip))
    return rows


def read_envelope_table(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """What the table shows; blocks delivered in two batches count once, and a retraction by the source counts."""
    rows = visible(spark, path)
    if start is not None:
        rows = rows.where(F.col("number") >= start)
    if end is not None:
        rows = rows.where(F.col("number") <= end)
    gone = F.coalesce(F.col("_deleted_"), F.lit(False)) if "_deleted_" in rows.columns else F.lit(False)
    keyed = rows.withColumn("_version_", F.col("batch").cast("bigint")).withColumn("_deleted_", gone)
    return resolve_retries(keyed.drop("batch"))


def durable_progress(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Newest shown block per batch: progress(run_id, entry, number, hash), read from the data itself."""
    best = F.max(F.struct("number", "hash")).alias("b")
    return visible(spark, path).groupBy(F.col("batch").cast("bigint").alias("entry")).agg(best).select(
        F.lit(run_id).alias("run_id"), "entry", "b.number", "b.hash")


def follow(blocks: DataFrame, path: str, checkpoint: str, start: int, stop: int | None = None,
           interval: str | None = None) -> StreamingQuery:
    """Store one row per block, empty blocks included; readers see those that are final and in a range asked for.

    With ``interval`` the query keeps running; without it reads what is there and ends. Resume comes
    from the stream's own checkpoint, so a completed range returns at once.
    """
    if stop is not None:
        check_range(start, stop)
    ask(blocks.sparkSession, path, start, stop)
    writer = blocks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: append_envelopes(batch, path, batch_id))
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def ingest(spark: SparkSession, blocks: DataFrame, path: str, checkpoint: str, start: int, stop: int) -> dict:
    """Bounded ingest of ``[start, stop)``; a later call may ask for more. Asking to stop before what is shown is an error."""
    check_range(start, stop)
    if folders.exists(spark, path):
        newest = visible(spark, path).agg(F.max("number")).first()[0]
        if newest is not None and newest >= stop:
            raise ValueError("stop block precedes the already ingested position")
        if newest == stop - 1:
            return {"stop": stop, "already_complete": True}
    follow(blocks, path, checkpoint, start, stop).awaitTermination()
    return {"stop": stop, "already_complete": False}


def deduplicated(stream: DataFrame, event_time: str, delay: str, keys: list[str]) -> DataFrame:
    """Retries within the delay count once; state is dropped behind the watermark."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


ENVELOPE_STREAM = S.ENVELOPE
