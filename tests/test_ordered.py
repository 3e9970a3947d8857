import random

import pytest
from pyspark.sql import functions as F

from chainfold.operators import ordered as O, telemetry as T


@pytest.fixture(scope="module")
def rows(spark):
    """One group holds most rows; the order must span several range partitions."""
    rng = random.Random(3)
    data = [(("hot" if rng.random() < .7 else rng.choice([None, "a", "b"])), i, rng.randint(0, 50)) for i in range(3000)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "g string, o int, v int").repartition(7)


def grouped(data):
    result = {}
    for g, o, v in sorted(data, key=lambda r: r[1]):
        result.setdefault(g, []).append((o, v))
    return result


def test_running_total_and_rank(rows):
    data, df = rows
    want = {}
    for g, items in grouped(data).items():
        total = 0
        for i, (o, v) in enumerate(items):
            total += v
            want[(g, o)] = (total, i + 1)
    got = {(r.g, r.o): r.running for r in O.running_total(df, ["g"], ["o"], "v").collect()}
    ranks = {(r.g, r.o): r["rank"] for r in O.row_rank(df, ["g"], ["o"]).collect()}
    assert got == {k: t for k, (t, _) in want.items()} and ranks == {k: n for k, (_, n) in want.items()}


def test_previous_row(rows):
    data, df = rows
    want = {}
    for g, items in grouped(data).items():
        for i, (o, v) in enumerate(items):
            want[(g, o)] = items[i - 1] if i else None
    got = {(r.g, r.o): tuple(r.previous) if r.previous else None
           for r in O.previous_row(df, ["g"], ["o"], ["o", "v"]).collect()}
    assert got == want


def test_nearest_rank(rows, spark):
    data, df = rows
    got = {r.g: r for r in O.nearest_rank(df.where("g IS NOT NULL"), ["g"], "v", {"p50": .5, "p95": .95}).collect()}
    for g, items in grouped(data).items():
        if g is None:
            continue
        values = sorted(v for _, v in items)
        at = lambda p: values[-(-len(values) * int(p * 100) // 100) - 1]
        assert (got[g].samples, got[g].min, got[g].p50, got[g].p95, got[g].max) == (
            len(values), values[0], at(.5), at(.95), values[-1])
    one = spark.createDataFrame([(5.0,)], "v double")
    assert O.nearest_rank(one, [], "v", {"p50": .5}).first().p50 == 5.0
    assert O.nearest_rank(one.limit(0), [], "v", {"p50": .5}).count() == 0
    for bad in (float("nan"), float("inf"), None):
        with pytest.raises(Exception, match="non-finite"):
            O.nearest_rank(spark.createDataFrame([(bad,)], "v double"), [], "v", {"p50": .5}).collect()


LAG = ("phase string, started_at_unix_ns bigint, rpc_finalized_block bigint, durable_block bigint, "
       "finalized_lag_blocks bigint, durable_block_age_seconds double, sample_duration_seconds double, error_type string")


def samples(spark, **change):
    rows = [dict(phase="live", started_at_unix_ns=i * 5_000_000_000, rpc_finalized_block=100 + i, durable_block=95 + i,
                 finalized_lag_blocks=5, durable_block_age_seconds=2.0, sample_duration_seconds=.1, error_type=None)
            for i in range(30)]
    rows[3]["finalized_lag_blocks"], rows[4]["finalized_lag_blocks"] = 999, -1
    for at, values in change.items():
        rows[int(at[1:])].update(values)
    return spark.createDataFrame([tuple(r.values()) for r in rows], LAG)


def test_live_window(spark):
    good = samples(spark)
    assert T.live_window_defects(good, ["phase"]).count() == 0
    row = T.live_window(good, ["phase"]).first()
    assert (row.lag_min, row.lag_p50, row.lag_max) == (-1, 5, 999)      # signed and slow samples are kept
    assert row.samples == 30 and row.window_seconds == 145 and row.durable_advanced == 29
    cases = {"failed": samples(spark, _5=dict(error_type="x")), "went back": samples(spark, _9=dict(durable_block=1)),
             "times": samples(spark, _9=dict(started_at_unix_ns=8 * 5_000_000_000)),
             "negative": samples(spark, _9=dict(sample_duration_seconds=-1.0)),
             "chain": samples(spark, _29=dict(rpc_finalized_block=100)),
             "ten": T.within(good, 0, 8 * 5_000_000_000)}
    for text, df in cases.items():
        assert any(text in r.reason for r in T.live_window_defects(df, ["phase"]).collect()), text


def test_summary_of_runs(spark):
    from chainfold.plans.runs import summarize_runs
    base = dict(module="m", blocks=10)
    second = 1_000_000_000
    runs = spark.createDataFrame([
        ("cold", 0, second, "m", 10), ("warm", 0, second, "m", 10), ("live", 0, 200 * second, "m", 10),
        ("live-tuned", 10 * second, 210 * second, "m", 10)],
        "phase string, started bigint, finished bigint, module string, blocks int")
    rows = samples(spark)
    both = rows.unionByName(rows.withColumn("phase", F.lit("live-tuned")))
    out = summarize_runs(runs, both, list(base))
    assert out["after_startup"].where("phase = 'live'").first().samples == 18
    assert {r.samples for r in out["overlap"].collect()} == {16}
    with pytest.raises(ValueError, match="differ"):
        summarize_runs(runs.withColumn("module", F.col("phase")), both, ["module"])


def test_null_group_is_a_group(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0)], "g string, v double")
    got = {r.g: (r.samples, r.mid) for r in O.nearest_rank(rows, ["g"], "v", {"mid": 0.5}).collect()}
    assert got == {"a": (2, 1.0), None: (2, 5.0)}


@pytest.mark.parametrize("seed", range(4))
def test_every_missing_block_is_in_one_gap(spark, seed):
    from chainfold.operators.continuity import interval_defects
    draw = random.Random(seed)
    there = sorted(draw.sample(range(10, 60), 18 * (seed > 0)))
    rows = spark.createDataFrame([(n, f"h{n}", f"h{n - 1}") for n in there], "number bigint, hash string, parent_hash string")
    got = interval_defects(rows, 5, 64).collect()
    assert {r.reason for r in got} == {"missing block"}
    assert sorted(n for r in got for n in range(r.number, r.last + 1)) == sorted(set(range(5, 65)) - set(there))
    assert all(r.number - 1 in there or r.number == 5 for r in got)
