"""Continuity carried by a stateful operator: what every source has delivered so far is the state, in stripes of numbers.

A source's chain is cut into stripes of ``STRIPE`` numbers, and each stripe is a key of its own. So a busy source is spread
over many tasks, a state value never outgrows one stripe, and blocks may come in any order, again, or years late: a gap
closes when its block arrives, and a rival hash is found however long ago the first one came.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain, pairwise

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from chainfold.operators.ordered import previous_row

STRIPE = 256
HELD = "version bigint, blocks string"      # JSON text: arrays would be converted element by element at every call
REPORT = ("source string, stripe bigint, version bigint, first bigint, last bigint, holes array<struct<number:bigint,last:bigint>>, "
          "conflicts array<bigint>, broken array<bigint>, overdue boolean")
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"
STORES_PER_CORE = 4
Held = dict[int, tuple[str, str, str, str]]     # number, in order: smallest and largest hash, smallest and largest parent


class Stripe(StatefulProcessor):
    """One stripe of one source: the smallest and largest hash and parent of each number, and a timer while numbers lack."""

    def __init__(self, patience_ms: int | None, size: int):
        self.patience_ms, self.size = patience_ms, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", HELD)

    def _load(self) -> tuple[int, Held]:
        stored = self.held.get()
        if stored is None:
            return 0, {}
        version, blocks = stored
        return version, {number: tuple(sides) for number, *sides in json.loads(blocks)}

    def _store(self, version: int, held: Held) -> None:
        self.held.update((version, json.dumps([(number, *sides) for number, sides in held.items()])))

    def _report(self, key: tuple, version: int, held: Held, overdue: bool) -> pd.DataFrame:
        source, stripe = key
        numbers = list(held)
        broken = [b for a, b in pairwise(numbers) if b == a + 1 and held[b][2:] != held[a][:2]]
        own = [n for n in numbers if n >= stripe * self.size]       # the number before belongs to the stripe before
        holes = [{"number": a + 1, "last": b - 1} for a, b in pairwise(own) if b > a + 1]
        first, last = (own[0], own[-1]) if own else (None, None)
        return pd.DataFrame({"source": [source], "stripe": [stripe], "version": [version], "first": pd.array([first], "Int64"),
                             "last": pd.array([last], "Int64"), "holes": [holes], "conflicts": [[n for n in own if held[n][0] != held[n][1]]],
                             "broken": [broken], "overdue": [overdue]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        version, held = self._load()
        changed = False
        for part in rows:
            for block in chain.from_iterable(map(zip, part["number"], part["hash"], part["parent_hash"])):
                number, own, parent = int(block[0]), *block[1:]
                old = held.get(number)
                new = (own, own, parent, parent) if old is None else (
                    min(old[0], own), max(old[1], own), min(old[2], parent), max(old[3], parent))
                if new != old:
                    held[number], changed = new, True
        if not changed and self.patience_ms is None:
            return                              # repeats alone: the newest report still holds
        held = dict(sorted(held.items()))
        self._store(version + 1, held)
        if self.patience_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if sum(n >= key[1] * self.size for n in held) < self.size:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)
        yield self._report(key, version + 1, held, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        version, held = self._load()
        self._store(version + 1, held)
        yield self._report(key, version + 1, held, True)

    def close(self) -> None:
        pass


def striped(blocks: DataFrame, size: int = STRIPE) -> DataFrame:
    """Each block in its stripe; the last one of a stripe also in the next, whose first block names it as parent.

    Rows without a number are no blocks and are left out; a null hash counts as empty.
    """
    stripe = ((F.col("number") - F.pmod(F.col("number"), F.lit(size))) / size).cast("bigint")
    last = F.pmod(F.col("number"), F.lit(size)) == size - 1
    rows = blocks.where(F.col("number").isNotNull()).select(
        F.coalesce("source", F.lit("")).alias("source"), "number", F.coalesce("hash", F.lit("")).alias("hash"),
        F.coalesce("parent_hash", F.lit("")).alias("parent_hash"),
        F.explode(F.when(last, F.array(stripe, stripe + 1)).otherwise(F.array(stripe))).alias("stripe"))
    return rows


PACKED = "source string, stripe bigint, number array<bigint>, hash array<string>, parent_hash array<string>"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lists = ["number", "hash", "parent_hash"]
    for batch in batches:
        packed = pa.Table.from_batches([batch]).group_by(["source", "stripe"], use_threads=False).aggregate([(name, "list") for name in lists])
        yield from packed.select(["source", "stripe", *[f"{name}_list" for name in lists]]).rename_columns(["source", "stripe", *lists]).to_batches()


def packed(rows: DataFrame) -> DataFrame:
    """Blocks of one stripe that come together as one row: Spark hands a keyed processor row after row, which costs more than the work."""
    return rows.mapInArrow(_pack, PACKED)


def watch(blocks: DataFrame, path: str, checkpoint: str, patience_ms: int | None = None, interval: str | None = None,
          size: int = STRIPE) -> StreamingQuery:
    """Follow a stream(source, number, hash, parent_hash); ``path`` gets a report of every stripe that changed.

    A stripe that stays incomplete for ``patience_ms`` without a new block is reported as overdue by a timer: a gap
    that nobody fills, or the newest stripe of a silent source (a full stripe opens the next one, so silence right at a
    border is seen too). With ``interval`` the query keeps running, which timers need; without it reads what is there and
    ends.
    """
    if patience_ms is not None and interval is None:
        raise ValueError("timers need a query that keeps running: give an interval")
    spark = blocks.sparkSession
    # Value states with timers live in RocksDB. Each partition is a store that commits in every batch, so there are no more
    # of them than keep the cores busy. The settings are taken at the start.
    stores = min(int(spark.conf.get(PARTITIONS)), STORES_PER_CORE * spark.sparkContext.defaultParallelism)
    asked = {PROVIDER: ROCKSDB, CHANGELOG: "true", PARTITIONS: str(stores)}
    before = {name: spark.conf.get(name, None) for name in asked}
    for name, value in asked.items():
        spark.conf.set(name, value)
    try:
        reports = packed(striped(blocks, size)).groupBy("source", "stripe").transformWithStateInPandas(
            Stripe(patience_ms, size), REPORT, "append", "None" if patience_ms is None else "ProcessingTime")
        writer = reports.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
        writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
        return writer.start(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def reports(spark: SparkSession, path: str) -> DataFrame:
    """The newest report of each stripe."""
    from pyspark.sql.types import _parse_datatype_string
    rows = spark.read.schema(_parse_datatype_string(REPORT)).parquet(path)
    names = [name for name in rows.columns if name not in ("source", "stripe")]
    return rows.groupBy("source", "stripe").agg(F.max_by(F.struct(*names), "version").alias("r")).select("source", "stripe", "r.*")


def defects(spark: SparkSession, path: str) -> DataFrame:
    """(source, number, last, reason) of everything delivered so far: gaps, rival blocks and broken parents.

    Gaps between stripes are found among the stripes alone, a 256th of the blocks; no source is gathered in one task.
    """
    newest = reports(spark, path).select("source", "stripe", "first", "last", "holes", "conflicts", "broken")
    inside = newest.select("source", F.explode(F.concat(
        F.transform("holes", lambda h: F.struct(h.number.alias("number"), h["last"].alias("last"), F.lit("missing block").alias("reason"))),
        F.transform("conflicts", lambda n: F.struct(n.alias("number"), n.alias("last"), F.lit("conflicting block").alias("reason"))),
        F.transform("broken", lambda n: F.struct(n.alias("number"), n.alias("last"), F.lit("broken parent").alias("reason"))))).alias("d")
        ).select("source", "d.*")
    edges = previous_row(newest.where("first IS NOT NULL").select("source", "stripe", "first", "last"), ["source"], ["stripe"], ["last"])
    between = edges.where("first > previous.last + 1").select(
        "source", (F.col("previous.last") + 1).alias("number"), (F.col("first") - 1).alias("last"), F.lit("missing block").alias("reason"))
    return inside.unionByName(between)


def overdue(spark: SparkSession, path: str) -> DataFrame:
    """Stripes (source, stripe, first, last) that are incomplete and got no block for longer than the patience."""
    return reports(spark, path).where("overdue").select("source", "stripe", "first", "last")
