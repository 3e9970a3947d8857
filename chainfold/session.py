"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. AQE turns a join into a broadcast only once the real
# size is known, and splits a hot address over many tasks.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording a Python call site for each of thousands of column calls is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Not needed where the package is installed on every node or given as ``--py-files``.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-chainfold-"), "chainfold.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("chainfold", os.path.relpath(path, home)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def local_session(name: str = "chainfold", cpus: int | str = 8, memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a session without one gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="spark-chainfold-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(frame: DataFrame) -> DataFrame:
    """Write the rows to the shared folder, so that later jobs see exactly these rows."""
    spark = frame.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return frame.checkpoint(eager=True)
