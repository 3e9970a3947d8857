"""Measured progress: every batch observes its own rows, and a listener keeps the figures under the run's id.

The figures come from Spark's observed metrics, so they are counted where the rows pass and cost no further job. They are
written as one small folder per batch, named by run and batch, so that a batch that runs again writes the same figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from chainfold.sources import folders

NAME = "followed"
SCHEMA = "rows bigint, oldest bigint, newest bigint, lag_blocks bigint, duration_ms bigint, rows_per_second double"
FIELDS = ["rows", "oldest", "newest", "lag_blocks"]


def observed(blocks: DataFrame, tip: str | None = None) -> DataFrame:
    """The same stream, with rows, oldest and newest block of each batch observed; the lag is behind column ``tip``, if any."""
    lag = F.max(tip) - F.max("number") if tip else F.lit(None).cast("bigint")
    return blocks.observe(NAME, F.count(F.lit(1)).alias("rows"), F.min("number").alias("oldest"), F.max("number").alias("newest"),
                          lag.alias("lag_blocks"))


class Recorder(StreamingQueryListener):
    """Writes the observed figures of every batch of one query; other queries of the session are not its business."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path, run

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if progress.name != self.run or not progress.observedMetrics or NAME not in progress.observedMetrics:
            return
        seen = progress.observedMetrics[NAME]
        if not seen["rows"]:
            return
        row = (*[seen[f] for f in FIELDS], progress.batchDuration, float(progress.processedRowsPerSecond))
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/run={self.run}/batch={progress.batchId}")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def follow_measured(blocks: DataFrame, sink, checkpoint: str, path: str, run: str, tip: str | None = None,
                    interval: str | None = None) -> StreamingQuery:
    """Run ``sink(batch, batch_id)`` for every batch of a stream(number, ...) under the name ``run``, with measured progress.

    The listener stays until the query ends; without ``interval`` the call waits for that.
    """
    spark = blocks.sparkSession
    recorder = Recorder(spark, path, run)
    spark.streams.addListener(recorder)
    writer = observed(blocks, tip).writeStream.queryName(run).option("checkpointLocation", checkpoint).foreachBatch(sink)
    query = (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
    if interval is None:
        try:
            query.awaitTermination()
            _drain(spark)
        finally:
            spark.streams.removeListener(recorder)
    return query


def _drain(spark: SparkSession) -> None:
    """Wait until the listeners have seen all that was posted."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch, rows, oldest, newest, lag_blocks, duration_ms, rows_per_second) of all batches that had rows."""
    if not folders.exists(spark, path):
        return spark.createDataFrame([], f"run string, batch bigint, {SCHEMA}")
    rows = spark.read.option("basePath", path).parquet(f"{path}/run=*/batch=*")
    return rows.select("run", F.col("batch").cast("bigint").alias("batch"), *FIELDS, "duration_ms", "rows_per_second")
