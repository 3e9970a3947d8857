"""Pages by position, canonical documents and the growth record, against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chainfold.functions import scalars as X
from chainfold.operators import paging as G
from chainfold.plans import growth, store


def test_pages_by_position_equal_ranked_pages(spark, tmp_path):
    draw = random.Random(1)
    keys = {(draw.choice(["a"] * 8 + ["b", "c", "d"]), f"{draw.randrange(5000):05d}") for _ in range(4000)}
    state = spark.createDataFrame([(a, s, f"v{s}") for a, s in keys], "address string, slot string, value string")
    store.write_sorted(state.repartition(7), str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    order = sorted(keys)
    assert {(r.address, r.slot): r.position for r in G.positioned(stored).collect()} == {k: i for i, k in enumerate(order)}
    pages = {(r.address, r.slot): r.page for r in G.stored_pages(stored, 7).collect()}
    assert pages == {(r.address, r.slot): r.page for r in G.numbered_pages(state, 7).collect()} and len(pages) == len(keys)
    plan = G.stored_pages(stored, 7)._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan               # no copy of the rows was written
    state.limit(50).write.mode("append").parquet(str(tmp_path / "s"))
    with pytest.raises(Exception, match="overlap"):
        G.positioned(spark.read.parquet(str(tmp_path / "s"))).collect()
    with pytest.raises(ValueError):
        G.stored_pages(stored, 0)


def test_canonical_documents(spark):
    draw = random.Random(3)

    def document(depth):
        kind = draw.choice(["leaf"] if depth == 0 else ["leaf", "list", "map", "map"])
        if kind == "leaf":
            return draw.choice([None, True, 7, -1, "é", "a \"quoted\" \\ text\n", 12345678901, "", 2.5])
        if kind == "list":
            return [document(depth - 1) for _ in range(draw.randrange(4))]
        return {draw.choice("abcxyz") + str(i): document(depth - 1) for i in range(draw.randrange(5))}

    def shuffled(value):
        if isinstance(value, dict):
            items = list(value.items())
            draw.shuffle(items)
            return {k: shuffled(v) for k, v in items}
        return [shuffled(v) for v in value] if isinstance(value, list) else value
    made = [document(4) for _ in range(60)]
    rows = [(i, json.dumps(shuffled(d), indent=draw.choice([None, 2]), ensure_ascii=draw.random() < .5)) for i, d in enumerate(made)]
    got = {r.i: r.c for r in spark.createDataFrame(rows, "i int, t string").select("i", X.canonical_document("t").alias("c")).collect()}
    assert got == {i: json.dumps(d, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for i, d in enumerate(made)}
    with pytest.raises(Exception):
        spark.createDataFrame([("{broken",)], "t string").select(X.canonical_document("t")).collect()
    values = spark.createDataFrame([('{"a":{"b":[1,2]}}',), ("{broken",), (None,)], "t string").select(
        X.document_value("t", "$.a.b[1]", "bigint").alias("v")).collect()
    assert [r.v for r in values] == [2, None, None]


SAMPLES = "cohort string, sample_finished_ns bigint, phase string, generation string, admitted boolean, accounted_allocated_bytes bigint, note string"


def test_growth_is_recorded_once(spark, tmp_path):
    path, now = str(tmp_path / "log"), 1000
    one = [("a", 1, "p", "g1", True, 5, "x"), ("a", 2, "p", "g1", True, 6, "x"), ("a", 3, "p", "g2", True, 7, "x"), (None, 2, "p", "g", True, 1, None),
           ("b", 1, "p", "g1", False, 5, "x"), ("b", 2, "p", "g1", True, None, "x"), ("b", 3, "p", "g1", True, 1, "x"), ("b", 5000, "p", "g2", True, 1, "x")]
    more = [("a", 4, "p", "g2", True, 8, "x"), ("a", 5, "q", "g2", True, 8, "x"), ("a", 6, "p", "g2", True, 8, "x"), ("c", 9, "p", "g1", True, 1, "y")]
    frame = lambda rows: spark.createDataFrame(rows, SAMPLES)
    assert growth.record_growth(spark, path, frame(one), now) == 4
    assert growth.record_growth(spark, path, frame(one), now) == 0
    assert growth.record_growth(spark, path, frame(one + more), now) == 3
    spark.range(1).write.json(f"{path}/upto=99")
    (tmp_path / "log" / "upto=99" / "_SUCCESS").unlink()        # an append that was not committed
    assert growth.record_growth(spark, path, frame(more[:2]), now) == 0
    got = sorted(((r.cohort or "", r.sample_finished_ns, r.note) for r in growth.recorded(spark, path, SAMPLES).collect()))
    assert got == [("", 2, None), ("a", 1, "x"), ("a", 3, "x"), ("a", 5, "x"), ("a", 6, "x"), ("b", 3, "x"), ("c", 9, "y")]
    assert growth.record_growth(spark, str(tmp_path / "none"), frame([]), now) == 0
