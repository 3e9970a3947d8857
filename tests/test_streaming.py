import time

import pytest
from pyspark.sql import functions as F

from chainfold import schema as S
from chainfold.operators import current_state as C
from chainfold.plans import store
from chainfold.streaming import bucketed, continuity, current, follow as W, linked, replay
from test_checkpoint import A, envelope, lifecycle_rows, w


def feed(spark, path, rows, schema, mode="append"):
    """One file per row, in order of arrival."""
    for row in rows:
        spark.createDataFrame([row], schema).coalesce(1).write.mode(mode).parquet(path)


def test_bounded_ingest_resumes(spark, tmp_path):
    source, table, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    feed(spark, source, [envelope(n, A) for n in range(1, 6)], S.ENVELOPE)
    blocks = W.stream_files(spark, source, S.ENVELOPE, files_per_batch=2)
    assert W.ingest(spark, blocks, table, offsets, 1, 4)["already_complete"] is False
    assert sorted(r.number for r in W.read_envelope_table(spark, table).collect()) == [1, 2, 3]
    assert W.ingest(spark, blocks, table, offsets, 1, 4)["already_complete"] is True
    with pytest.raises(ValueError, match="precedes"):
        W.ingest(spark, blocks, table, offsets, 1, 3)
    with pytest.raises(ValueError):
        W.ingest(spark, blocks, table, offsets, 4, 4)
    assert W.read_envelope_table(spark, table, 2, 2).count() == 1
    from chainfold.operators.continuity import progress_match, progress_regressions
    progress = W.durable_progress(spark, table, "run")
    assert sorted(r.number for r in progress.collect()) == [2, 3] and progress_regressions(progress).count() == 0
    stored = W.read_envelope_table(spark, table)
    assert all(r.matches for r in progress_match(progress, stored, stored.select("number", "hash")).collect())


def test_bounded_ingest_grows_on_the_same_checkpoint(spark, tmp_path):
    source, table, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    feed(spark, source, [envelope(n, A) for n in range(1, 8)], S.ENVELOPE)
    blocks = W.stream_files(spark, source, S.ENVELOPE, files_per_batch=2)
    for stop in (4, 7):
        assert W.ingest(spark, blocks, table, offsets, 1, stop)["already_complete"] is False
        assert sorted(r.number for r in W.read_envelope_table(spark, table).collect()) == list(range(1, stop))


def test_a_block_waits_until_a_later_one_proves_it(spark, tmp_path):
    source, table, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for number, tip, seen in ((1, 1, [1]), (2, 1, [1]), (3, 3, [1, 2, 3])):
        row = spark.createDataFrame([envelope(number, A)], S.ENVELOPE).withColumn("finalized_number", F.lit(tip).cast("bigint"))
        row.coalesce(1).write.mode("append").parquet(source)
        W.follow(W.stream_files(spark, source, row.schema), table, offsets, 1).awaitTermination()
        assert sorted(r.number for r in W.read_envelope_table(spark, table).collect()) == seen


def test_the_union_of_asked_ranges_shows(spark, tmp_path):
    source, table, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    spark.createDataFrame([envelope(n, A) for n in range(0, 12)], S.ENVELOPE).coalesce(1).write.parquet(source)
    blocks = W.stream_files(spark, source, S.ENVELOPE)
    for start, stop, shown in ((0, 3, [0, 1, 2]), (7, 9, [0, 1, 2, 7, 8]), (2, 4, [0, 1, 2, 3, 7, 8]), (10, None, [0, 1, 2, 3, 7, 8, 10, 11])):
        W.follow(blocks, table, offsets, start, stop).awaitTermination()
        assert sorted(r.number for r in W.read_envelope_table(spark, table).collect()) == shown
    assert W.asked_ranges(spark, table) == [(0, 4), (7, 9), (10, None)]


def test_only_final_blocks_enter(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([envelope(n, A) for n in range(1, 6)], S.ENVELOPE).withColumn("finalized_number", F.lit(3).cast("bigint"))
    rows.write.parquet(source)
    W.follow(W.stream_files(spark, source, rows.schema), table, str(tmp_path / "o"), 1).awaitTermination()
    assert sorted(r.number for r in W.read_envelope_table(spark, table).collect()) == [1, 2, 3]


def test_repeated_batch_is_harmless(spark, tmp_path):
    table = str(tmp_path / "out")
    batch = spark.createDataFrame([envelope(1, A), envelope(2, A)], S.ENVELOPE)
    for _ in range(2):
        W.append_envelopes(batch, table, 0)
    W.append_envelopes(batch.where("number = 2"), table, 1)
    assert W.read_envelope_table(spark, table).count() == 2


def test_replay_in_chunks_equals_one_pass(spark, tmp_path):
    """Blocks beyond the stop and behind a gap wait; the offsets stay the same throughout."""
    source, history, prefix = (str(tmp_path / n) for n in ("in", "history", "prefix"))
    rows = lifecycle_rows()
    blocks = lambda: W.stream_files(spark, source, S.ENVELOPE, files_per_batch=1)
    run = lambda stop=None: replay.replay(spark, blocks(), history, prefix, str(tmp_path / "o"), [A], 1, stop).awaitTermination()
    top = lambda: store.current_generation(spark, prefix)["header"]["number"]
    feed(spark, source, [rows[0], rows[1], rows[3]], S.ENVELOPE)
    run(2)
    assert top() == 1
    run()
    assert top() == 2                                   # block 3 is missing
    feed(spark, source, [rows[2], rows[1]], S.ENVELOPE)
    run()
    record = store.current_generation(spark, prefix)
    assert record["header"]["number"] == 4 and record["nonzero_slots"] == 2
    got = {int(r.slot, 16): int(r.value, 16) for r in store.generation_storage(spark, prefix, record["generation"]).collect()}
    assert got == {2: 22, 3: 33}
    feed(spark, source, [rows[1][:1] + (w(77),) + rows[1][2:]], S.ENVELOPE)
    with pytest.raises(Exception):
        run()                                           # another block 2 than the one folded


def test_late_change_does_not_win(spark, tmp_path):
    schema = "number bigint, ordinal bigint, address string, slot string, value string, kind string"
    source = str(tmp_path / "in")
    feed(spark, source, [(9, 1, "a", w(1), w(5), "s"), (3, 1, "a", w(1), w(4), "s"), (2, 1, "a", w(2), w(9), "s"),
                         (5, 1, "a", None, None, "reset"), (4, 1, "a", w(3), w(9), "s"), (9, 2, "a", w(4), w(0), "s")], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    got = replay.fold_changes(spark, stream, "reset", str(tmp_path / "state"), str(tmp_path / "o"), merge_every=2)
    assert [(r.slot, r.value) for r in got.collect()] == [(w(1), w(5))]


def test_bucketed_folds_leave_the_prefix_in_place(spark, tmp_path):
    """Folds every few batches, late changes, resets, a repeated batch; the prefix side of the join has no exchange."""
    import random
    draw = random.Random(6)
    schema = "number bigint, ordinal bigint, address string, slot string, value string, kind string"
    rows = [(n, o, draw.choice("aab"), None if draw.random() < .05 else w(draw.randrange(9)), w(draw.randrange(4)), "s") for n in range(40) for o in range(4)]
    rows = [r if r[3] else (*r[:3], None, None, "reset") for r in rows]
    draw.shuffle(rows)
    source, path = str(tmp_path / "in"), str(tmp_path / "state")
    for i in range(0, len(rows), 20):
        spark.createDataFrame(rows[i:i + 20], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    got = bucketed.fold_changes(spark, stream, "reset", path, str(tmp_path / "o"), fold_every=3, buckets=4)
    newest, cut = {}, {}
    for n, o, a, s, v, kind in rows:
        if kind == "reset":
            cut[a] = max(cut.get(a, (-1, -1)), (n, o))
        elif ((n, o), v) > newest.get((a, s), ((-1, -1), "")):
            newest[a, s] = ((n, o), v)
    want = {(a, s, v) for (a, s), (at, v) in newest.items() if at > cut.get(a, (-1, -1)) and v != w(0)}
    assert {(r.address, r.slot, r.value) for r in got.collect()} == want
    prefix, batch, buckets, behind = bucketed._newest(spark, path)
    assert (batch, buckets, behind) == (5, 4, [6, 7])
    plan = bucketed.folded(prefix, bucketed._deltas(spark, path, behind))._jdf.queryExecution().executedPlan().toString()
    side = plan.split("SortMergeJoin")[1].split("Bucketed: true")[0]
    assert "Bucketed: true" in plan and "Exchange" not in side, plan
    bucketed.fold(spark, path)
    bucketed.fold(spark, path)
    assert {(r.address, r.slot, r.value) for r in bucketed.state(spark, path).collect()} == want


def test_continuity_across_batches(spark, tmp_path):
    schema = "source string, number bigint, hash string, parent_hash string"
    source = str(tmp_path / "in")
    feed(spark, source, [("a", 1, "h1", "h0"), ("b", 7, "x", "y"), ("a", 2, "h2", "h1"), ("a", 4, "h4", "h3"),
                         ("a", 5, "h5", "bad"), ("a", 5, "other", "h4"), ("a", 5, "h5", "bad"), ("a", 2, "h2", "h1"),
                         ("b", 8, "z", "x")], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    got = continuity.watch_continuity(spark, stream, str(tmp_path / "c"), str(tmp_path / "o"))
    assert sorted((r.source, r.number, r.last, r.reason) for r in got.collect()) == [
        ("a", 2, 2, "late block"), ("a", 3, 3, "missing block"), ("a", 5, 5, "broken parent"), ("a", 5, 5, "late block")]


LINKS = "source string, number bigint, hash string, parent_hash string"


def test_stateful_continuity_over_stripes(spark, tmp_path):
    """One row a batch, in any order, over many stripes: gaps, late blocks, repeats, rivals, negative numbers, nulls."""
    import random
    draw = random.Random(2)
    rows = [("a", n, f"h{n}", f"h{n - 1}") for n in range(-3, 30) if n not in (3, 4, 11, 12, 13, 14, 15, 16, 17, 18, 19)]
    rows += [("a", 7, "rival", "h6"), ("b", 100, "x", "w"), ("b", 103, "y", "q"), ("b", 104, "z", "not y"), (None, 1, None, None), ("b", None, "n", "n")]
    rows += draw.sample(rows, 6)
    draw.shuffle(rows)
    source = str(tmp_path / "in")
    for i in range(0, len(rows), 6):
        spark.createDataFrame(rows[i:i + 6], LINKS).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(LINKS).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):                      # the second call finds nothing new
        linked.watch(stream, str(tmp_path / "r"), str(tmp_path / "o"), size=4).awaitTermination()
    want = [("a", 3, 4, "missing block"), ("a", 11, 19, "missing block"), ("a", 7, 7, "conflicting block"), ("a", 8, 8, "broken parent"),
            ("b", 101, 102, "missing block"), ("b", 104, 104, "broken parent")]
    assert sorted(tuple(r) for r in linked.defects(spark, str(tmp_path / "r")).collect()) == sorted(want)
    spark.createDataFrame([("a", n, f"h{n}", f"h{n - 1}") for n in (3, 4, 12)], LINKS).coalesce(1).write.mode("append").parquet(source)
    linked.watch(stream, str(tmp_path / "r"), str(tmp_path / "o"), size=4).awaitTermination()
    want = [w for w in want if w[1] not in (3, 11)] + [("a", 11, 11, "missing block"), ("a", 13, 19, "missing block")]
    assert sorted(tuple(r) for r in linked.defects(spark, str(tmp_path / "r")).collect()) == sorted(want)


def test_a_silent_source_is_overdue(spark, tmp_path):
    source = str(tmp_path / "in")
    put = lambda rows: spark.createDataFrame(rows, LINKS).coalesce(1).write.mode("append").parquet(source)
    put([("full", n, f"h{n}", f"h{n - 1}") for n in range(8)] + [("part", 0, "h0", "")])
    stream = spark.readStream.schema(LINKS).parquet(source)
    with pytest.raises(ValueError, match="interval"):
        linked.watch(stream, str(tmp_path / "r"), str(tmp_path / "o"), patience_ms=1)
    query = linked.watch(stream, str(tmp_path / "r"), str(tmp_path / "o"), patience_ms=1, interval="1 second", size=4)
    try:
        due, end = set(), time.time() + 60
        while time.time() < end and len(due) < 2:
            time.sleep(1)
            if any((tmp_path / "r").glob("*.parquet")):
                due = {(r.source, r.stripe) for r in linked.overdue(spark, str(tmp_path / "r")).collect()}
    finally:
        query.stop()
    assert due == {("full", 2), ("part", 0)}            # stripes 0 and 1 are full, which opens the next one
    assert linked.defects(spark, str(tmp_path / "r")).count() == 0


def test_current_state_versions(spark, tmp_path):
    folder = str(tmp_path / "state")
    slot = "address string, slot string, value string, block_num bigint, ordinal bigint"
    account = ("address string, balance string, nonce decimal(20,0), code_hash string, block_num bigint, "
               "balance_block_num bigint, nonce_block_num bigint, code_block_num bigint")
    head = "block_num bigint, number bigint, hash string, state_root string"

    def batch(number_of_batch, number, value, balance):
        current.merge_batch(
            spark, folder, number_of_batch, spark.createDataFrame([("a", w(1), w(value), number, 1)], slot),
            spark.createDataFrame([("a", balance, None, None, number, number if balance else None, None, None)], account),
            spark.createDataFrame([(number, number, f"h{number}", "r")], head), merge_every=2)
    batch(0, 5, 50, "7")
    batch(1, 3, 30, None)                       # older block, later batch
    batch(1, 3, 30, None)                       # repeated batch
    batch(2, 4, 40, None)
    from chainfold.plans.diagnostics import read_current
    top, accounts, storage = read_current(spark, folder)
    assert top["number"] == 5 and storage.first().value == w(50) and accounts.first().balance == "7"
    assert C.head(spark.createDataFrame([(1,), (3,)], "block_num bigint")).first().block_num == 3
