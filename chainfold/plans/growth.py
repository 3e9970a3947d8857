"""A durable record of growth: samples are compared with what was recorded last, and only changes are appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chainfold.operators import telemetry as T
from chainfold.sources import folders

ORDER = "sample_finished_ns"
IDENTITY = ["phase", "generation"]


def recorded(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All records appended so far; a folder whose write was not committed does not count."""
    whole = [v for v in folders.partition_values(spark, path, "upto") if folders.written(spark, f"{path}/upto={v}")]
    rows = spark.read.schema(schema).option("mode", "FAILFAST")
    return rows.json([f"{path}/upto={v}" for v in whole]) if whole else spark.createDataFrame([], schema)


def record_growth(spark: SparkSession, path: str, samples: DataFrame, now_ns: int | Column, group: str = "cohort") -> int:
    """Append the admitted samples whose (phase, generation) differs from the one before them in their cohort.

    The first sample of a cohort counts, and the last record of each cohort is the one before its first new sample.
    Samples at or before that record were seen and add nothing, so a run may be repeated, or given all samples again.
    An append is one folder named by its newest sample: if it fails, the next run writes the same folder anew.
    Returns the number of records added. Every cohort is ordered over ranges, none is gathered.
    """
    columns = [group, ORDER, *IDENTITY, *[c for c in samples.columns if c not in (group, ORDER, *IDENTITY)]]
    schema = ", ".join(f"{c} {samples.schema[c].dataType.simpleString()}" for c in columns)
    last = T.latest_record(recorded(spark, path, schema).select(*columns), [group], ORDER).withColumn("_recorded", F.lit(True))
    known = last.select(F.col(group).alias("_group"), F.col(ORDER).alias("_until"))
    fresh = (T.admit_growth(samples, now_ns).join(known, F.col(group).eqNullSafe(F.col("_group")), "left")
             .where(F.col("_until").isNull() | (F.col(ORDER) > F.col("_until"))).select(*columns, F.lit(False).alias("_recorded")))
    changed = T.changes_only(last.select(*columns, "_recorded").unionByName(fresh), [group], [ORDER], IDENTITY)
    new = changed.where("NOT _recorded").select(*columns).persist()
    try:
        count, newest = new.agg(F.count("*"), F.max(ORDER)).first()
        if count:
            new.write.mode("overwrite").json(f"{path}/upto={newest}")
        return count
    finally:
        new.unpersist()
