"""Samples, windows, sizes and streams over the event table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chainfold.functions import scalars as X
from chainfold.operators import block_end as E, current_state as C, retention as R, telemetry as T
from chainfold.queries.base import EV, LATEST, changes, events, query, table
from chainfold.queries.state import envelopes, kinds
from chainfold.session import shared_folder
from chainfold.sources import files as FI
from chainfold.sources.files import log_lines
from chainfold.streaming import bucketed as SB, current as CU, follow as W, linked as SL, progress as SP

NEAREST = """count(*) AS samples, min({v}) AS min, quantile_disc({v}, 0.5) AS p50, quantile_disc({v}, 0.95) AS p95, max({v}) AS max"""


@query("latency_distribution", f"SELECT event_type, {NEAREST.format(v='value')} FROM events GROUP BY event_type")
def latency_distribution(spark, d):
    return T.distribution(table(spark, d, "events"), "value", ["event_type"], nonnegative=True)


@query("latency_distribution_all", f"SELECT {NEAREST.format(v='value')} FROM events")
def latency_distribution_all(spark, d):
    return T.distribution(table(spark, d, "events"), "value")


@query("admission_reasons", """SELECT event_id, r AS reason FROM (
SELECT event_id, 'budget_headroom_exhausted' AS r FROM events WHERE CAST(round(value * 100) AS BIGINT) + 500 >= 5000
UNION ALL SELECT event_id, 'filesystem_free_space_below_floor' FROM events WHERE user_id < 20)""")
def admission_reasons(spark, d):
    used = F.round(F.col("value") * 100).cast("bigint")
    reasons = T.admission_reasons(used, F.lit(500), F.lit(5000), F.col("user_id"), F.lit(20))
    return table(spark, d, "events").select("event_id", reasons.alias("r")).select("event_id", F.explode("r").alias("reason"))


@query("admitted_growth", """SELECT event_id FROM events WHERE event_type <> 'error' AND user_id > 3
AND event_id % 120 - 20 BETWEEN 0 AND 60""")
def admitted_growth(spark, d):
    """Samples that count: admitted, complete, not from the future and at most a minute old."""
    finished = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    now = finished + (F.col("event_id") % 120 - 20) * 1_000_000_000
    used = F.when(F.col("user_id") > 3, F.col("user_id"))
    return table(spark, d, "events").where(T.counts_as_evidence(F.col("event_type") != "error", used, finished, now)).select(
        "event_id")


def lag_samples(spark, d):
    """Four followers sampling: the chain is at the event number, the durable block behind it."""
    n = F.col("event_id")
    return table(spark, d, "events").select(
        F.concat(F.lit("p"), (n % 4).cast("string")).alias("phase"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("started_at_unix_ns"),
        n.alias("rpc_finalized_block"), (n - F.col("user_id") % 5).alias("durable_block"),
        (F.col("user_id") % 5).alias("finalized_lag_blocks"), F.col("value").alias("durable_block_age_seconds"),
        (F.col("value") / 8).alias("sample_duration_seconds"),
        F.when((n % 4 == 3) & (F.col("event_type") == "error"), "timeout").alias("error_type"))


LAG = """s AS (SELECT 'p' || event_id % 4 AS phase, epoch_us(ts) * 1000 AS t0, event_id AS rpc, event_id - user_id % 5 AS dur, user_id % 5 AS lag,
  value AS age, value / 8 AS call, event_id % 4 = 3 AND event_type = 'error' AS failed FROM events),
lk AS (SELECT *, lag(dur) OVER w AS pd, lag(t0) OVER w AS pa FROM s WINDOW w AS (PARTITION BY phase ORDER BY t0, rpc, dur))"""


@query("live_window_defects", f"""WITH {LAG}
SELECT phase, 'failed sample' AS reason FROM lk GROUP BY phase HAVING count(*) FILTER (WHERE failed) > 0
UNION ALL SELECT phase, 'durable block went back' FROM lk GROUP BY phase HAVING count(*) FILTER (WHERE dur < pd) > 0
UNION ALL SELECT phase, 'sample times do not rise' FROM lk GROUP BY phase HAVING count(*) FILTER (WHERE t0 <= pa) > 0""")
def live_window_defects(spark, d):
    return T.live_window_defects(lag_samples(spark, d), ["phase"])


@query("live_window", f"""WITH {LAG} SELECT phase, count(*) AS samples, (max(t0) - min(t0)) / 1e9 AS window_seconds,
  max(rpc) - min(rpc) AS chain_advanced, arg_max(dur, (t0, rpc, dur)) - arg_min(dur, (t0, rpc, dur)) AS durable_advanced,
  CAST(min(lag) AS DOUBLE) AS lag_min, CAST(quantile_disc(lag, 0.5) AS DOUBLE) AS lag_p50, CAST(quantile_disc(lag, 0.95) AS DOUBLE) AS lag_p95, CAST(max(lag) AS DOUBLE) AS lag_max,
  min(age) AS age_min, quantile_disc(age, 0.5) AS age_p50, quantile_disc(age, 0.95) AS age_p95, max(age) AS age_max,
  min(call) AS call_min, quantile_disc(call, 0.5) AS call_p50, quantile_disc(call, 0.95) AS call_p95, max(call) AS call_max
FROM s GROUP BY phase""")
def live_window(spark, d):
    return T.live_window(lag_samples(spark, d), ["phase"])


@query("run_overlap", f"""WITH {LAG}, r AS (SELECT phase, min(t0) AS started, max(t0) AS finished FROM s GROUP BY phase)
SELECT max(started) + 60000000000 AS start, min(finished) AS finish, max(started) + 60000000000 <= min(finished) AS overlaps FROM r""")
def run_overlap(spark, d):
    runs = lag_samples(spark, d).groupBy("phase").agg(F.min("started_at_unix_ns").alias("started"),
                                                     F.max("started_at_unix_ns").alias("finished"))
    return T.run_overlap(runs)


@query("overlap_samples", f"""WITH {LAG}, r AS (SELECT phase, min(t0) AS started, max(t0) AS finished FROM s GROUP BY phase),
o AS (SELECT max(started) + 60000000000 AS a, min(finished) AS b FROM r) SELECT phase, count(*) AS n FROM s, o WHERE t0 BETWEEN a AND b GROUP BY phase""")
def overlap_samples(spark, d):
    window = run_overlap(spark, d).first()
    return T.within(lag_samples(spark, d), window["start"], window["finish"]).groupBy("phase").agg(F.count("*").alias("n"))


@query("freshness", f"""WITH b AS (SELECT event_id AS number, sha256('b' || event_id) AS hash, epoch_us(ts) // 1000000 AS t FROM events)
SELECT e.event_id, user_id % 7 - 2 AS finalized_lag_blocks, epoch_us(e.ts) // 1000000 + 30 - b.t AS durable_block_age_seconds
FROM events e JOIN b ON b.number = e.event_id - (user_id % 7 - 2) AND e.event_type <> 'error'""")
def freshness(spark, d):
    """Lag is signed: the durable block may be ahead of an older observation."""
    n = F.col("event_id")
    word = lambda c: F.sha2(F.concat(F.lit("b"), c.cast("string")), 256)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    durable = n - (F.col("user_id") % 7 - 2)
    ev = table(spark, d, "events")
    samples = ev.where("event_type <> 'error'").select(
        "event_id", n.alias("finalized_block"), durable.alias("durable_block"), word(durable).alias("durable_hash"),
        (seconds + 30).alias("now_seconds"))
    blocks = ev.select(n.alias("number"), word(n).alias("hash"), seconds.alias("timestamp"))
    return T.freshness(samples, blocks).select("event_id", "finalized_lag_blocks", "durable_block_age_seconds")


@query("sample_gaps", """WITH e AS (SELECT user_id % 3 AS host, epoch_us(ts) AS t0, CAST(round(value * 100) AS BIGINT) AS used, event_type = 'error' AS bad, FROM events),
g AS (SELECT host, t0, used, t0 - lag(t0) OVER (PARTITION BY host ORDER BY t0) AS gap FROM e WHERE NOT bad),
a AS (SELECT host, count(*) AS samples, max(used) AS peak, max(gap) AS largest_gap FROM g GROUP BY host)
SELECT a.*, f.failures FROM a JOIN (SELECT host, count(*) FILTER (WHERE bad) AS failures FROM e GROUP BY host) f USING (host)""")
def sample_gaps(spark, d):
    rows = table(spark, d, "events").select(
        (F.col("user_id") % 3).alias("host"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.round(F.col("value") * 100).cast("bigint").alias("used"), "event_type")
    return T.sample_gaps(rows, ["host"], "at", "used", F.col("event_type") == "error")


@query("rejected_stages", """SELECT DISTINCT user_id % 3 AS host, event_type AS stage, CASE WHEN value > 200 THEN 'budget' ELSE 'floor' END AS reason
FROM events WHERE value > 60 AND event_type IN ('view', 'click')""")
def rejected_stages(spark, d):
    guards = table(spark, d, "events").where("event_type IN ('view', 'click')").select(
        (F.col("user_id") % 3).alias("host"), F.col("event_type").alias("stage"), (F.col("value") <= 60).alias("admitted"),
        F.array(F.when(F.col("value") > 200, "budget").otherwise("floor")).alias("reasons"))
    return T.rejected_stages(guards, ["host"])


@query("growth_changes", """WITH g AS (SELECT event_id, user_id % 2 AS cohort, event_id // 40 AS generation, event_type = 'signup' AS phase FROM events),
c AS (SELECT *, lag(generation) OVER w AS pg, lag(phase) OVER w AS pp FROM g WINDOW w AS (PARTITION BY cohort ORDER BY event_id))
SELECT event_id, cohort, generation, phase FROM c WHERE pg IS NULL OR generation <> pg OR phase <> pp""")
def growth_changes(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", (F.col("user_id") % 2).alias("cohort"), F.expr("event_id div 40").alias("generation"),
        (F.col("event_type") == "signup").alias("phase"))
    return T.changes_only(rows, ["cohort"], ["event_id"], ["generation", "phase"])


@query("latest_record", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def latest_record(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return T.latest_record(rows, ["user_id"], "event_id")


@query("telemetry_rollup", """SELECT user_id % 4 AS run, max(CASE WHEN event_type <> 'view' THEN user_id + event_id % 9 END) AS max_running_jobs,
  arg_max(event_id, event_id) FILTER (WHERE event_type = 'click') AS last_processed FROM events GROUP BY 1""")
def telemetry_rollup(spark, d):
    """Log lines in three shapes are parsed back; jobs are summed over the map, absent keys stay unknown."""
    n, u = F.col("event_id"), F.col("user_id")
    jobs = F.when(F.col("event_type") != "view", F.create_map(F.lit("a"), u, F.lit("b"), n % 9))
    body = F.to_json(F.struct(jobs.alias("progress_running_jobs"), F.when(F.col("event_type") == "click", n)
                              .alias("progress_total_processed_blocks"), n.cast("string").alias("last_block")))
    stamp = F.concat(F.lpad(n.cast("string"), 12, "0"), F.lit("|"), (u % 4).cast("string"))
    noise = table(spark, d, "events").select(F.concat(stamp, F.lit(" INFO something else "), body).alias("value"))
    lines = table(spark, d, "events").select(F.concat(stamp, F.lit(" INFO stream stats "), body).alias("value"))
    progress = log_lines(lines.unionByName(noise), "progress")
    run = F.split("timestamp", r"\|")
    return T.telemetry_rollup(progress.withColumn("run", run[1].cast("bigint")).withColumn("timestamp", run[0]), ["run"])


@query("run_differences", """WITH r AS (SELECT event_type, count(*) AS n, max(user_id) AS top, min(user_id) AS low FROM events WHERE event_type IN ('view', 'click') GROUP BY 1),
v AS (SELECT * FROM r WHERE event_type = 'view'), c AS (SELECT * FROM r WHERE event_type = 'click'),
l AS (SELECT 'n' AS key, CAST(v.n AS VARCHAR) AS left_value, CAST(c.n AS VARCHAR) AS right_value FROM v, c
UNION ALL SELECT 'top', CAST(v.top AS VARCHAR), CAST(c.top AS VARCHAR) FROM v, c UNION ALL SELECT 'low', CAST(v.low AS VARCHAR), CAST(c.low AS VARCHAR) FROM v, c)
SELECT * FROM l WHERE left_value <> right_value""")
def run_differences(spark, d):
    runs = table(spark, d, "events").groupBy(F.col("event_type").alias("phase")).agg(
        F.count("*").alias("n"), F.max("user_id").alias("top"), F.min("user_id").alias("low"))
    return T.run_differences(runs, "view", "click", ["n", "top", "low"])


# ---------------------------------------------------------------- sizes

DENSE_COUNTS = f"""WITH {EV}, de AS (SELECT number, event_type, cents, ordinal, ts, user_id % 10 AS a, k % 5 AS sl FROM ev),
s AS (SELECT number, count(*) AS n FROM (SELECT DISTINCT number, a, sl FROM de WHERE event_type <> 'signup') GROUP BY 1),
b AS (SELECT number, count(*) AS n FROM (SELECT DISTINCT number, a FROM de WHERE event_type = 'purchase') GROUP BY 1),
t AS (SELECT number, epoch_us(min(ts)) // 1000000 AS t FROM de GROUP BY 1)
SELECT count(*) AS blocks, CAST(sum(s.n) AS BIGINT) AS storage_rows, CAST(sum(coalesce(b.n, 0)) AS BIGINT) AS balances_rows,
  (max(t) - min(t)) / (count(*) - 1) AS mean_interval_seconds FROM t LEFT JOIN s USING (number) LEFT JOIN b USING (number)"""


@query("output_meter", DENSE_COUNTS)
def output_meter(spark, d):
    return T.output_meter(envelopes(spark, d), ["storage", "balances"]).select(
        "blocks", "storage_rows", "balances_rows", "mean_interval_seconds")


@query("output_bytes")
def output_bytes(spark, d):
    """Bytes per block as JSON; the length depends on the engine's JSON text, so there is no SQL twin."""
    return T.output_meter(envelopes(spark, d), ["storage"]).select("blocks", "total_bytes", "mean_bytes", "max_bytes")


@query("monthly_cost", """WITH m AS (SELECT event_type, avg(length(props)) AS mean_bytes FROM events GROUP BY 1)
SELECT event_type, mean_bytes * 5760000 / 1099511627776.0 AS tib_per_month, mean_bytes * 5760000 / 1099511627776.0 * 25 + 5760000 * 0.0001 AS cost FROM m""")
def monthly_cost(spark, d):
    meter = table(spark, d, "events").groupBy("event_type").agg(F.avg(F.length("props")).alias("mean_bytes"))
    return T.monthly_cost(meter, 5_760_000, 25.0, 0.0001).drop("mean_bytes")


@query("size_report", f"WITH {EV} SELECT CAST(number % 3 AS INTEGER) AS generation, count(*) AS rows, true AS stored FROM ch GROUP BY 1")
def size_report(spark, d):
    """Stored parts of a written generation; how many files and bytes they take is the writer's choice."""
    path = f"{shared_folder(spark)}/sizes-{uuid.uuid4().hex}"
    changes(spark, d).withColumn("generation", F.expr("number % 3")).repartition("generation").write.partitionBy(
        "generation").parquet(path)
    report = T.size_report(spark.read.parquet(path), ["generation"])
    return report.select("generation", "rows", ((F.col("files") > 0) & (F.col("bytes") >= F.col("files"))).alias("stored"))


@query("partition_bounds", f"""WITH {EV} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, min(number) AS first, max(number) AS last FROM ev GROUP BY 1""")
def partition_bounds(spark, d):
    return R.partition_bounds(events(spark, d).select("number", F.to_date("ts").cast("string").alias("day")), "day")


# ---------------------------------------------------------------- streams

FILE_ROWS = 100_000


def files_per_batch(rows) -> int:
    """Files that a tenth of the table is dealt over, so that a micro-batch of any size is read by many tasks."""
    return max(1, -(-rows.count() // (10 * FILE_ROWS)))


def event_stream(spark, d, files: str | None = None):
    """The event file as a stream, with the views' columns; or the files of ``delivered``, a tenth of them in each micro-batch."""
    rows = table(spark, d, "events")
    schema = rows.schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch(rows) if files else 64)
    raw = reader.parquet(files) if files else reader.option("pathGlobFilter", "events.parquet").parquet(d)
    k = F.get_json_object("props", "$.k").cast("bigint")
    return raw.select(
        F.expr("event_id div 100").alias("number"), F.col("event_id").alias("ordinal"),
        X.number_word("user_id", 40).alias("address"), X.number_word(k).alias("slot"),
        F.when(F.col("event_type") == "error", F.lit(X.ZERO_WORD)).otherwise(X.number_word(F.col("event_id") + 1)).alias("value"),
        F.col("event_type").alias("kind"), "user_id", "ts")


def fresh_folder(spark) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def delivered(spark, d) -> str:
    """All events in files by range of ids for ten batches, which arrive in any order, then a tenth of the events once more for two."""
    at, rows = f"{fresh_folder(spark)}/in", table(spark, d, "events")
    files = files_per_batch(rows)
    rows.repartitionByRange(10 * files, "event_id").write.parquet(at)
    rows.where("event_id % 10 = 3").repartitionByRange(2 * files, "event_id").write.mode("append").parquet(at)
    return at


@query("stream_fold_state", f"WITH {EV}, {LATEST} SELECT * FROM st WHERE value <> '{X.ZERO_WORD}'")
def stream_fold_state(spark, d):
    at = fresh_folder(spark)
    folded = SB.fold_changes(spark, event_stream(spark, d, delivered(spark, d)), "signup", f"{at}/state", f"{at}/offsets")
    return folded.select("address", "slot", "value")


@query("stream_follow", """SELECT event_id AS number, sha256('b' || event_id) AS hash FROM events
  WHERE event_id <= (SELECT max(event_id - CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) FROM events)""")
def stream_follow(spark, d):
    """Every block at or below the last final one shows; a second call over the same range adds nothing."""
    at = fresh_folder(spark)
    blocks = event_stream(spark, d, delivered(spark, d)).select(
        F.col("ordinal").alias("number"), F.sha2(F.concat(F.lit("b"), F.col("ordinal").cast("string")), 256).alias("hash"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        (F.col("ordinal") - F.when(F.col("kind") == "error", 1).otherwise(0)).alias("finalized_number"))
    W.follow(blocks, f"{at}/blocks", f"{at}/offsets", 0).awaitTermination()
    W.follow(blocks, f"{at}/blocks", f"{at}/offsets", 0).awaitTermination()
    return W.read_envelope_table(spark, f"{at}/blocks").select("number", "hash")


@query("measured_progress", """SELECT count(*) + count(*) FILTER (WHERE event_id % 10 = 3) AS rows, min(event_id) AS oldest, max(event_id) AS newest,
  true AS many_batches, true AS equal_to_data FROM events""")
def measured_progress(spark, d):
    """What the listener recorded of a followed stream, batch by batch, against counts of what each batch stored."""
    at, run = fresh_folder(spark), f"run{uuid.uuid4().hex}"
    blocks = event_stream(spark, d, delivered(spark, d)).select(F.col("ordinal").alias("number"), "user_id")
    SP.follow_measured(blocks, lambda batch, n: batch.write.mode("overwrite").parquet(f"{at}/rows/batch={n}"),
                       f"{at}/offsets", f"{at}/progress", run)
    told = SP.progress_table(spark, f"{at}/progress").where(F.col("run") == run)
    found = spark.read.parquet(f"{at}/rows").groupBy(F.col("batch").cast("bigint").alias("of")).agg(
        F.count("*").alias("n"), F.min("number").alias("low"), F.max("number").alias("high"))
    same = F.col("rows").eqNullSafe(F.col("n")) & F.col("oldest").eqNullSafe(F.col("low")) & F.col("newest").eqNullSafe(F.col("high"))
    return told.join(found, F.col("batch") == F.col("of"), "full").agg(
        F.sum("rows").alias("rows"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest"),
        (F.count("*") >= 10).alias("many_batches"), F.every(same).alias("equal_to_data"))


@query("stream_ingest_grows", "SELECT event_id AS number, sha256('b' || event_id) AS hash FROM events")
def stream_ingest_grows(spark, d):
    """Half of the range, then all of it, on one checkpoint."""
    at = fresh_folder(spark)
    blocks = event_stream(spark, d, delivered(spark, d)).select(
        F.col("ordinal").alias("number"), F.sha2(F.concat(F.lit("b"), F.col("ordinal").cast("string")), 256).alias("hash"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"))
    stop = table(spark, d, "events").agg(F.max("event_id")).first()[0] + 1
    for asked in (stop // 2, stop):
        W.ingest(spark, blocks, f"{at}/blocks", f"{at}/offsets", 0, asked)
    return W.read_envelope_table(spark, f"{at}/blocks").select("number", "hash")


@query("stream_dedup", "SELECT event_id AS ordinal, user_id FROM events")
def stream_dedup(spark, d):
    """A tenth of the events comes again in later batches; the state behind the watermark knows them."""
    at = fresh_folder(spark)
    stream = event_stream(spark, d, delivered(spark, d)).select("ordinal", "user_id", "ts")
    once = W.deduplicated(stream, "ts", "60 days", ["ordinal"])
    once.writeStream.option("checkpointLocation", f"{at}/offsets").trigger(availableNow=True).format("parquet").start(
        f"{at}/rows").awaitTermination()
    return spark.read.parquet(f"{at}/rows").select("ordinal", "user_id")


@query("stream_continuity", """WITH b AS (SELECT CAST(user_id % 4 AS VARCHAR) AS source, event_id // 4 AS number, min('h' || event_id) AS low, max('h' || event_id) AS high,
  min('h' || (event_id - 4)) AS low_parent, max('h' || (event_id - 4)) AS high_parent FROM events WHERE event_type <> 'error' GROUP BY 1, 2)
SELECT source, before + 1 AS number, number - 1 AS last, 'missing block' AS reason
  FROM (SELECT source, number, lag(number) OVER (PARTITION BY source ORDER BY number) AS before FROM b) WHERE number > before + 1
UNION ALL SELECT source, number, number, 'conflicting block' FROM b WHERE low <> high
UNION ALL SELECT b.source, b.number, b.number, 'broken parent' FROM b JOIN b a ON a.source = b.source AND b.number = a.number + 1
  WHERE b.low_parent <> a.low OR b.high_parent <> a.high""")
def stream_continuity(spark, d):
    """Twelve batches and more, in any order, a tenth of the blocks twice: gaps close and rivals meet across batches."""
    at = fresh_folder(spark)
    word = lambda c: F.concat(F.lit("h"), c.cast("string"))
    blocks = event_stream(spark, d, delivered(spark, d)).where("kind <> 'error'").select(
        (F.col("user_id") % 4).cast("string").alias("source"), F.expr("ordinal div 4").alias("number"),
        word(F.col("ordinal")).alias("hash"), word(F.col("ordinal") - 4).alias("parent_hash"))
    SL.watch(blocks, f"{at}/reports", f"{at}/offsets").awaitTermination()
    return SL.defects(spark, f"{at}/reports")


@query("stream_current_state", f"""WITH {EV} SELECT address, slot, arg_max(value, (number, ordinal)) AS value,
  max((number, ordinal))[1] AS block_num, max((number, ordinal))[2] AS ordinal FROM ch GROUP BY address, slot""")
def stream_current_state(spark, d):
    at = fresh_folder(spark)

    def reduced(batch):
        rows = batch.where("kind <> 'signup'")
        nothing = rows.limit(0)
        at_block = nothing.select("number", "ordinal", "address")
        accounts = C.current_accounts(
            rows.where("kind = 'purchase'").select("number", "ordinal", "address", F.col("ordinal").cast("string").alias("new_value")),
            at_block.withColumn("new_value", F.lit(0)), at_block.withColumn("new_hash", F.lit("")))
        head = batch.agg(F.max("number").alias("number")).select(
            F.col("number").alias("block_num"), "number", F.lit("").alias("hash"), F.lit("").alias("state_root"))
        return C.current_storage(rows), accounts, head

    event_stream(spark, d, delivered(spark, d)).writeStream.option("checkpointLocation", f"{at}/offsets").foreachBatch(
        lambda batch, batch_id: CU.reduce_batch(spark, f"{at}/state", batch_id, batch, reduced)).trigger(
        availableNow=True).start().awaitTermination()
    return CU.read_current(spark, f"{at}/state")["storage"]


PREFIX = f"""WITH {EV}, de AS (SELECT number, ordinal, event_type, value,
  '0x' || lpad(lower(to_hex(user_id % 10)), 40, '0') AS address, '0x' || lpad(lower(to_hex(k % 5)), 64, '0') AS slot FROM ev),
la AS (SELECT address, slot, max(ordinal) AS p, arg_max(value, ordinal) AS value FROM de WHERE event_type <> 'signup' GROUP BY ALL),
rc AS (SELECT address, max(ordinal) AS r FROM de WHERE event_type = 'signup' GROUP BY 1),
fs AS (SELECT la.address, la.slot, la.value FROM la LEFT JOIN rc USING (address) WHERE (r IS NULL OR p > r) AND value <> '{X.ZERO_WORD}')"""
ACCOUNTS = ["0x" + f"{i:040x}" for i in range(10)]


def prefix_of(spark, d) -> tuple[str, dict]:
    """Envelopes folded in two steps through private generations: the second starts from the first. Folder and record."""
    from chainfold.plans import compaction
    at = fresh_folder(spark)
    word = lambda c: F.concat(F.lit("0x"), c)
    rows = envelopes(spark, d).withColumns({
        "hash": word(F.col("hash")), "parent_hash": word(F.col("parent_hash")), "accounts": F.lit(",".join(ACCOUNTS)),
        "state_root": word(F.col("hash")), "schema_version": F.lit(1), "producer_version": F.lit(5)})
    rows.write.parquet(f"{at}/blocks")
    stored = spark.read.parquet(f"{at}/blocks")
    top = stored.agg(F.max("number")).first()[0]
    compaction.compact(spark, f"{at}/prefix", stored, ACCOUNTS, 0, top // 2)
    return at, compaction.compact(spark, f"{at}/prefix", stored, ACCOUNTS, 0)


@query("compacted_prefix", f"{PREFIX} SELECT * FROM fs")
def compacted_prefix(spark, d):
    from chainfold.plans import store
    at, record = prefix_of(spark, d)
    return store.generation_storage(spark, f"{at}/prefix", record["generation"])


@query("prefix_copy", f"""{PREFIX} SELECT f.address, count(*) AS slots, min(slot) AS first_slot, max(slot) AS last_slot,
  (SELECT max(number) FROM ev) AS folded_to, 1 AS generations, true AS audited FROM fs f GROUP BY f.address""")
def prefix_copy(spark, d):
    """A folded prefix audited, copied elsewhere and audited there; one generation is left, and the report knows it."""
    from chainfold.plans import compaction, store
    at, record = prefix_of(spark, d)
    audit = compaction.audit_prefix(spark, f"{at}/prefix")
    measured = compaction.isolated_copy(spark, f"{at}/prefix", f"{at}/copy")
    again = compaction.audit_prefix(spark, f"{at}/copy")
    same = audit["generation"] == again["generation"] and all(audit[name] == value for name, value in measured.items())
    report = compaction.growth_report(spark, f"{at}/copy").agg(
        F.count("*").alias("generations"), F.sum("rows").alias("stored"), F.every("active").alias("active")).first()
    rows = store.generation_storage(spark, f"{at}/copy", record["generation"])
    good = same and report["active"] and report["stored"] == measured["nonzero_slots"]
    return rows.groupBy("address").agg(
        F.count("*").alias("slots"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot")).withColumns({
            "folded_to": F.lit(again["header"]["number"]), "generations": F.lit(report["generations"]), "audited": F.lit(bool(good))})


# ---------------------------------------------------------------- files

@query("appended_records", "SELECT event_type, count(*) AS records, min(event_id) AS first, max(event_id) AS last, sum(user_id) AS users FROM events GROUP BY event_type")
def appended_records(spark, d):
    """A JSON-lines log appended to three times, its last line torn; the complete records are all that is read."""
    at, schema = fresh_folder(spark), "event_id bigint, event_type string, user_id bigint"
    rows = table(spark, d, "events").select("event_id", "event_type", "user_id")
    for part in range(3):
        FI.append_rows(rows.where(F.col("event_id") % 3 == part), f"{at}/log")
    torn = rows.where("event_id % 50 = 0").select(F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_ty')).alias("value"))
    torn.write.mode("append").text(f"{at}/log")
    return FI.complete_rows(spark, f"{at}/log", schema).groupBy("event_type").agg(
        F.count("*").alias("records"), F.min("event_id").alias("first"), F.max("event_id").alias("last"), F.sum("user_id").alias("users"))


@query("json_documents", "SELECT c_custkey // 1000 AS part, count(*) AS customers, CAST(sum(c_nationkey) AS BIGINT) AS nations FROM customer GROUP BY 1")
def json_documents(spark, d):
    """A document for each thousand customers, each in a file of several lines, read with a declared schema."""
    at = fresh_folder(spark)
    held = table(spark, d, "customer").groupBy(F.expr("c_custkey div 1000").alias("part")).agg(
        F.collect_list(F.struct(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"))).alias("customers"))
    doc = F.to_json(F.struct("part", "customers"), {"pretty": "true"})
    held.select("part", doc.alias("value")).write.partitionBy("part").text(f"{at}/docs")
    read = FI.json_document(spark, f"{at}/docs/*", "part bigint, customers array<struct<key:bigint,nation:bigint>>")
    return read.select("part", F.size("customers").cast("bigint").alias("customers"),
                       F.aggregate("customers", F.lit(0).cast("bigint"), lambda a, c: a + c["nation"]).alias("nations"))


@query("scalar_forms", f"""WITH {EV} SELECT ordinal AS event_id, address, CAST(CASE WHEN user_id % 3 = 0 THEN NULL ELSE CAST(ordinal AS HUGEINT) * 1048576 END AS VARCHAR) AS quantity,
  CASE WHEN user_id % 2 = 0 THEN 2 ELSE 1 END AS named, k AS generation, 'https_' || event_type AS source FROM ev""")
def scalar_forms(spark, d):
    """Addresses in mixed case, hex quantities (some too wide), keys by prefix, and fields of a JSON manifest."""
    ev, n = table(spark, d, "events"), F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    mixed = F.concat(F.lit("0x"), F.upper(F.lpad(F.hex("user_id"), 40, "0")))
    wide = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("0x1"), F.repeat(F.lit("0"), 16))).otherwise(
        F.concat(F.lit("0x000"), F.hex(n), F.lit("00000")))
    labels = F.map_from_arrays(F.array(F.lit("net.a"), F.when(F.col("user_id") % 2 == 0, "net.b").otherwise("disk"), F.lit("cpu")), F.array(n, n, n))
    manifest = F.to_json(F.struct(F.struct(k.alias("generation")).alias("header"), F.concat(F.lit("https_"), "event_type").alias("source")))
    typed = X.manifest_fields(manifest, "header struct<generation: bigint>, source string")
    return ev.select("event_id", X.canonical_address(mixed).alias("address"), X.quantity_u64(wide).cast("string").alias("quantity"),
                     F.size(X.keys_with_prefix(labels, "net.")).alias("named"), typed["header"]["generation"].alias("generation"),
                     typed["source"].alias("source"))
