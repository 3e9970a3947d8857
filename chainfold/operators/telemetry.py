"""Samples, lag, capacity and cost. Missing telemetry stays unknown; it never becomes zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chainfold.operators.ordered import nearest_rank, previous_row

LEVELS = {"p50": 0.5, "p95": 0.95}
MIN_SAMPLES = 10
STARTUP_NS = 60_000_000_000
FRESH_NS = 60_000_000_000


def distribution(samples: DataFrame, value: str, group: list[str] = (), nonnegative: bool = False) -> DataFrame:
    """samples, min, p50, p95, max by nearest rank."""
    if nonnegative:
        ok = F.col(value) >= 0
        samples = samples.withColumn(value, F.when(ok, F.col(value)).otherwise(
            F.raise_error(F.lit("negative observation")).cast("double")))
    return nearest_rank(samples, list(group), value, LEVELS)


# ---------------------------------------------------------------- admission

def admission_reasons(used: Column, headroom: Column, budget: Column, free: Column, floor: Column) -> Column:
    wide = lambda c: c.cast("decimal(38,0)")
    return F.filter(F.array(
        F.when(wide(used) + wide(headroom) >= wide(budget), F.lit("budget_headroom_exhausted")),
        F.when(wide(free) < wide(floor), F.lit("filesystem_free_space_below_floor"))), lambda r: r.isNotNull())


def counts_as_evidence(admitted: Column, bytes_known: Column, finished: Column, now: Column) -> Column:
    """A sample counts when admitted, complete, not from the future and at most 60 s old."""
    age = now - finished
    return F.coalesce(admitted, F.lit(False)) & bytes_known.isNotNull() & F.coalesce(
        age.between(0, FRESH_NS), F.lit(False))


# ---------------------------------------------------------------- live windows

def live_window_defects(samples: DataFrame, group: list[str]) -> DataFrame:
    """Why a window of lag samples proves nothing: (group, reason)."""
    at = "started_at_unix_ns"
    linked = previous_row(samples, group, [at, "rpc_finalized_block", "durable_block"],
                          [at, "durable_block"])
    first, last = F.struct(at, "rpc_finalized_block", "durable_block"), F.struct(
        at, "rpc_finalized_block", "durable_block")
    facts = linked.groupBy(*group).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("error_type").isNotNull(), 1)).alias("errors"),
        F.min(first).alias("first"), F.max(last).alias("last"),
        F.count(F.when(F.col("durable_block") < F.col("previous.durable_block"), 1)).alias("back"),
        F.count(F.when(F.col(at) <= F.col(f"previous.{at}"), 1)).alias("same_time"),
        F.count(F.when(F.col("sample_duration_seconds").cast("double") < 0, 1)).alias("negative"))
    reasons = F.filter(F.array(
        F.when(F.col("n") < MIN_SAMPLES, F.lit("fewer than ten samples")),
        F.when(F.col("errors") > 0, F.lit("failed sample")),
        F.when(F.col("last.rpc_finalized_block") <= F.col("first.rpc_finalized_block"), F.lit("chain did not grow")),
        F.when(F.col("last.durable_block") <= F.col("first.durable_block"), F.lit("durable block did not grow")),
        F.when(F.col("back") > 0, F.lit("durable block went back")),
        F.when(F.col("same_time") > 0, F.lit("sample times do not rise")),
        F.when(F.col("negative") > 0, F.lit("negative sample duration"))), lambda r: r.isNotNull())
    return facts.select(*group, reasons.alias("_r")).select(*group, F.explode("_r").alias("reason"))


def live_window(samples: DataFrame, group: list[str]) -> DataFrame:
    """Advance of chain and durable block over the window, and lag and age distributions."""
    at = "started_at_unix_ns"
    key = F.struct(at, "rpc_finalized_block", "durable_block")
    facts = samples.groupBy(*group).agg(F.count("*").alias("samples"), F.min(key).alias("a"), F.max(key).alias("b"))
    wide = facts.select(
        *group, "samples", ((F.col(f"b.{at}") - F.col(f"a.{at}")) / F.lit(1e9)).alias("window_seconds"),
        (F.col("b.rpc_finalized_block") - F.col("a.rpc_finalized_block")).alias("chain_advanced"),
        (F.col("b.durable_block") - F.col("a.durable_block")).alias("durable_advanced"))
    # The three measures are ranked together as one long table.
    measures = {"lag": "finalized_lag_blocks", "age": "durable_block_age_seconds", "call": "sample_duration_seconds"}
    values = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(column).cast("double").alias("v"))
                       for name, column in measures.items()])
    long = samples.select(*group, values.alias("values")).select(*group, F.inline("values"))
    ranked = distribution(long, "v", [*group, "measure"])
    spread = ranked.groupBy(*group).agg(*[
        F.max(F.when(F.col("measure") == name, F.col(c))).alias(f"{name}_{c}")
        for name in measures for c in ("min", "p50", "p95", "max")])
    return wide.join(spread, group)


def within(samples: DataFrame, start: Column | int, finish: Column | int, at: str = "started_at_unix_ns") -> DataFrame:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return samples.where((F.col(at) >= lit(start)) & (F.col(at) <= lit(finish)))


def run_overlap(runs: DataFrame) -> DataFrame:
    """Common window of all runs(run, started, finished), startup excluded."""
    window = runs.agg((F.max("started") + F.lit(STARTUP_NS)).alias("start"), F.min("finished").alias("finish"))
    return window.withColumn("overlaps", F.col("start") <= F.col("finish"))


def freshness(samples: DataFrame, blocks: DataFrame) -> DataFrame:
    """Signed finality lag and age of the durable block, from the block row it names."""
    known = blocks.select(F.col("number").alias("durable_block"), F.col("hash").alias("durable_hash"),
                          F.col("timestamp").alias("block_seconds"))
    return samples.join(known, ["durable_block", "durable_hash"]).withColumn(
        "finalized_lag_blocks", F.col("finalized_block") - F.col("durable_block")).withColumn(
        "durable_block_age_seconds", F.col("now_seconds") - F.col("block_seconds")).drop("block_seconds")


def sample_gaps(samples: DataFrame, group: list[str], at: str, used: str, failed: Column) -> DataFrame:
    """Count, failures, peak use and the largest gap between good samples."""
    good = previous_row(samples.where(~failed), group, [at], [at])
    gaps = good.groupBy(*group).agg(
        F.count("*").alias("samples"), F.max(used).alias("peak"),
        F.max(F.coalesce(F.greatest(F.col(at) - F.col(f"previous.{at}"), F.lit(0)), F.lit(0))).alias("largest_gap"))
    failures = samples.groupBy(*group).agg(F.count(F.when(failed, 1)).alias("failures"))
    return failures.join(gaps, group, "left").select(*group, F.coalesce("samples", F.lit(0)).alias("samples"),
                                                     "failures", "peak", "largest_gap")


def rejected_stages(guards: DataFrame, group: list[str]) -> DataFrame:
    """Distinct stages that were not admitted, with each reason."""
    return guards.where(~F.coalesce("admitted", F.lit(False))).select(
        *group, "stage", F.explode("reasons").alias("reason")).distinct()


def changes_only(records: DataFrame, group: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Records that differ from the one before them in the group; the first always counts."""
    seen = previous_row(records, group, order, values)
    same = F.lit(True)
    for name in values:
        same = same & F.col(name).eqNullSafe(F.col(f"previous.{name}"))
    return seen.where(F.col("previous").isNull() | ~same).drop("previous")


def admit_growth(samples: DataFrame, now_ns: int | Column) -> DataFrame:
    """Samples that count as evidence of growth at ``now_ns``, a time or a column of times."""
    now = now_ns if isinstance(now_ns, Column) else F.lit(now_ns)
    return samples.where(counts_as_evidence(F.col("admitted"), F.col("accounted_allocated_bytes"), F.col("sample_finished_ns"), now))


def latest_record(records: DataFrame, group: list[str], order: str) -> DataFrame:
    rest = [c for c in records.columns if c not in group and c != order]
    best = F.max(F.struct(order, *rest)).alias("r")
    return records.groupBy(*group).agg(best).select(*group, "r.*")


# ---------------------------------------------------------------- run logs

def telemetry_rollup(progress: DataFrame, group: list[str] = ()) -> DataFrame:
    """Largest number of running jobs and last reported total. No report at all stays NULL."""
    jobs = F.aggregate(F.map_values("progress_running_jobs"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    total = F.col("progress_total_processed_blocks")
    return progress.groupBy(*group).agg(
        F.max(jobs).alias("max_running_jobs"),
        F.max(F.when(total.isNotNull(), F.struct("timestamp", total.alias("total"))))["total"].alias("last_processed"))


def run_differences(runs: DataFrame, left: str, right: str, keys: list[str]) -> DataFrame:
    """Identity keys on which two phases of runs(phase, …) disagree; missing on both sides is a difference."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("v"))
                                for k in keys])).alias("pair")
    long = runs.where(F.col("phase").isin(left, right)).select("phase", pairs).select("phase", "pair.*")
    sides = long.groupBy("key").agg(F.max(F.when(F.col("phase") == left, F.col("v"))).alias("left_value"),
                                    F.max(F.when(F.col("phase") == right, F.col("v"))).alias("right_value"))
    return sides.where(F.col("left_value").isNull() | F.col("right_value").isNull()
                       | (F.col("left_value") != F.col("right_value")))


# ---------------------------------------------------------------- output size and cost

def output_meter(envelopes: DataFrame, groups: list[str], group: list[str] = ()) -> DataFrame:
    """Blocks, bytes and changed rows; size is the JSON length of the row."""
    size = F.length(F.to_json(F.struct(*[c for c in envelopes.columns if c not in group]))).cast("bigint")
    sized = envelopes.withColumn("_bytes", size)
    measured = sized.groupBy(*group).agg(
        F.count("*").alias("blocks"), F.sum("_bytes").alias("total_bytes"), F.max("_bytes").alias("max_bytes"),
        *[F.sum(F.size(g)).alias(f"{g}_rows") for g in groups],
        F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"))
    return measured.withColumn("mean_bytes", F.col("total_bytes") / F.col("blocks")).withColumn(
        "mean_interval_seconds", F.when(F.col("blocks") > 1, (F.col("_last") - F.col("_first"))
                                        / (F.col("blocks") - 1))).drop("_first", "_last")


def monthly_cost(meter: DataFrame, blocks_per_month: int, price_per_tib: float, price_per_block: float) -> DataFrame:
    tib = F.col("mean_bytes") * F.lit(blocks_per_month) / F.lit(float(1 << 40))
    return meter.withColumn("tib_per_month", tib).withColumn(
        "cost", tib * F.lit(price_per_tib) + F.lit(blocks_per_month * price_per_block))


def size_report(files: DataFrame, group: list[str]) -> DataFrame:
    """Rows, files and bytes per stored part; each file's size counts once."""
    per_file = files.groupBy(*group, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes"))
    return per_file.groupBy(*group).agg(F.sum("rows").alias("rows"), F.count("*").alias("files"),
                                        F.sum("bytes").alias("bytes"))
