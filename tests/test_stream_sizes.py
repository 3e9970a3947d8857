"""Streams over larger tables: batches of many files, and stripes that only repeats reach."""

from pyspark.sql import functions as F

from chainfold.operators import current_state as C
from chainfold.queries import telemetry
from chainfold.streaming import current, linked

LINKS = "source string, number bigint, hash string, parent_hash string"


def test_a_batch_grows_by_files(spark, tmp_path, monkeypatch):
    """A tenth of a larger table is more than one file, so more than one task; the number of batches stays."""
    monkeypatch.setattr(telemetry, "FILE_ROWS", 250)
    rows = spark.range(10_000).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.0D AS value", "'{\"k\": 3}' AS props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    files = telemetry.delivered(spark, str(tmp_path))
    stored = spark.read.parquet(files)
    assert len(stored.inputFiles()) == 12 * 4 and stored.count() == 11_000 and stored.distinct().count() == 10_000
    seen = []
    stream = telemetry.event_stream(spark, str(tmp_path), files)
    stream.writeStream.option("checkpointLocation", str(tmp_path / "o")).foreachBatch(lambda b, n: seen.append(b.count())).trigger(
        availableNow=True).start().awaitTermination()
    assert len(seen) == 12 and sum(seen) == 11_000


def test_repeats_alone_make_no_new_report(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "r")
    rows = [("a", n, f"h{n}", f"h{n - 1}") for n in range(10) if n != 5]
    settings = [linked.PROVIDER, linked.CHANGELOG, linked.PARTITIONS]
    before = [spark.conf.get(name, None) for name in settings]
    for more, reports in ((rows, 3), (rows[2:], 3), ([("a", 5, "h5", "h4")], 4)):
        spark.createDataFrame(more, LINKS).coalesce(1).write.mode("append").parquet(source)
        linked.watch(spark.readStream.schema(LINKS).parquet(source), out, str(tmp_path / "o"), size=4).awaitTermination()
        assert spark.read.parquet(out).count() == reports
    assert linked.defects(spark, out).count() == 0
    assert [spark.conf.get(name, None) for name in settings] == before


def test_a_batch_is_read_once_for_all_three_tables(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    rows = "number bigint, ordinal bigint, address string, slot string, value string"
    for part in ([(1, 1, "a", "s", "1"), (1, 2, "a", "s", "2"), (2, 3, "b", "s", "3")], [(1, 0, "a", "s", "0"), (3, 4, "b", "t", "4")]):
        spark.createDataFrame(part, rows).coalesce(1).write.mode("append").parquet(source)

    def reduced(batch):
        at, none = ["number", "ordinal", "address"], batch.limit(0)
        accounts = C.current_accounts(batch.select(*at, F.col("value").alias("new_value")), none.select(*at, F.lit(0).alias("new_value")),
                                      none.select(*at, F.lit("").alias("new_hash")))
        head = batch.agg(F.max("number").alias("number")).select(
            F.col("number").alias("block_num"), "number", F.lit("").alias("hash"), F.lit("").alias("state_root"))
        return C.current_storage(batch), accounts, head

    def add(batch, batch_id):
        for _ in range(2):                      # a repeated batch
            current.reduce_batch(spark, folder, batch_id, batch, reduced, merge_every=2)
    stream = spark.readStream.schema(rows).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "o")).foreachBatch(add).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2 * 5       # once for each call
    found = current.read_current(spark, folder)
    assert sorted(tuple(r) for r in found["storage"].collect()) == [("a", "s", "2", 1, 2), ("b", "s", "3", 2, 3), ("b", "t", "4", 3, 4)]
    assert sorted((r.address, r.balance, r.block_num) for r in found["accounts"].collect()) == [("a", "2", 1), ("b", "4", 3)]
    assert found["head"].first().number == 3
    assert not list((tmp_path / "state" / "rows").glob("batch=*"))
