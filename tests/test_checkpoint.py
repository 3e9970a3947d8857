"""Whole scenarios: compaction, checkpoints, pages, pins, retention, export and restore."""

import json

import pytest
from pyspark.sql import functions as F

import world
from chainfold import schema as S
from chainfold.plans import checkpoint as K, compaction as C, diagnostics as G, portable as P, readers as R, removal as M, store
from chainfold.plans.reduction import Source
from chainfold.sources import folders

A, B = "0x" + "aa" * 20, "0x" + "bb" * 20
NO_CODE = world.NO_CODE


def w(n):
    return f"0x{n:064x}"


def envelope(number, accounts, storage=(), balances=(), nonces=(), codes=(), lifecycle=(), **change):
    row = dict(number=number, hash=w(number + 1000), parent_hash=w(number + 999), timestamp=number * 3, state_root=w(5),
               producer_version=5, accounts=accounts, schema_version=1,
               storage=[(a, w(s), w(v), o) for a, s, v, o in storage], balances=list(balances), nonces=list(nonces),
               codes=list(codes), lifecycle=list(lifecycle))
    row.update(change)
    return tuple(row.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, S.ENVELOPE)


def target(number, accounts, bare=False):
    """Proof bundle of a block; the stream's block gets the encoded header's hash and root."""
    header, rows = world.bundle(number, "", accounts, parent_hash=w(number + 999), timestamp=number * 3)
    encoded = world.encoded_header(header)
    return {"format_version": 1, "chain_id": 56, "header": header, "header_trust": "provider-finalized-header",
            "header_rlp": None if bare else encoded}, rows


def close(rows, bundle):
    """Give the last envelope the header's identity."""
    last = list(rows[-1])
    last[1], last[4] = bundle["header"]["hash"], bundle["header"]["state_root"]
    return rows[:-1] + [tuple(last)]


from decimal import Decimal as N64  # noqa: E402

BIG = N64(2 ** 63 + 9)


def first_rows():
    return [envelope(100, A, [(A, 1, 7, 1), (A, 2, 3, 2)], [(A, "40", 3)], [(A, BIG, 4)]),
            envelope(101, A, [(A, 2, 8, 9)])]


def first(spark, root):
    bundle, rows = target(101, {A: (2 ** 63 + 9, 40, "0x", {w(1): w(7), w(2): w(8)})})
    env = frame(spark, close(first_rows(), bundle))
    proofs = spark.createDataFrame(rows, world.PROOFS)
    return K.build_checkpoint(spark, root, bundle, proofs, [Source("one", env, [A], 100)]), proofs, bundle


def slots(spark, root, snapshot):
    return {(r.address, int(r.slot, 16)): int(r.value, 16) for r in store.snapshot_storage(spark, root, snapshot).collect()}


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("root"))
    record, proofs, bundle = first(spark, root)
    return root, record, proofs, bundle


def test_first_checkpoint(spark, published):
    root, record, _, _ = published
    assert record["nonzero_slots"] == 2 and slots(spark, root, record["snapshot_id"]) == {(A, 1): 7, (A, 2): 8}
    row = R.show(spark, root, record["snapshot_id"], A)
    assert row["nonce"] == BIG and row["balance"] == "40" and row["code_hash"] == NO_CODE
    with pytest.raises(LookupError):
        R.show(spark, root, record["snapshot_id"], B)


def test_continuation_with_new_cohort_and_quiet_fields(spark, published, tmp_path):
    """Nonce and code stay from the base, balance changes, a second account joins from its own stream."""
    root, base, _, base_bundle = published
    state = {A: (2 ** 63 + 9, 50, "0x", {w(2): w(9)}), B: (1, 0, "0x6000", {w(7): w(11)})}
    bundle, rows = target(103, state)
    parent = base_bundle["header"]["hash"]
    old = [envelope(102, A, [(A, 1, 0, 5)], parent_hash=parent),
           envelope(103, A, [(A, 2, 9, 6)], [(A, "50", 7)])]
    new = [envelope(102, B, [(B, 7, 11, 1)], codes=[(B, "0x" + world.keccak(b"\x60\x00").hex(), "0x6000", 2)]),
           envelope(103, B, nonces=[(B, N64(1), 3)])]
    a, b = frame(spark, close(old, bundle)), frame(spark, close(new, bundle))
    proofs = spark.createDataFrame(rows, world.PROOFS)
    sources = [Source("old", a, [A], 102), Source("new", b, [B], 102)]
    record = K.build_checkpoint(spark, root, bundle, proofs, sources, base["snapshot_id"])
    assert slots(spark, root, record["snapshot_id"]) == {(A, 2): 9, (B, 7): 11}
    got = {r.address: r for r in store.snapshot_accounts(spark, root, record["snapshot_id"]).collect()}
    assert got[A].nonce == BIG and got[A].balance == "50" and got[B].code == "0x6000" and got[B].balance == "0"
    assert [r.snapshot_id for r in store.ready_checkpoints(spark, root).collect()][0] == record["snapshot_id"]
    # the base stays readable, and nothing half-built appears
    assert slots(spark, root, base["snapshot_id"]) == {(A, 1): 7, (A, 2): 8}
    ready = store.ready_checkpoints(spark, root).count()
    bad = [("does not hold", [Source("old", a, [A], 102)], "sources and proofs"),
           ("overlap", sources + [Source("again", b, [B], 102)], "two sources"),
           ("late start", [Source("old", a, [A], 103), sources[1]], "behind the base")]
    for _, wrong, text in bad:
        with pytest.raises(ValueError, match=text):
            K.build_checkpoint(spark, root, bundle, proofs, wrong, base["snapshot_id"])
    lost = frame(spark, close([old[0], envelope(103, A, [], [(A, "50", 7)])], bundle))
    with pytest.raises(ValueError, match="storage root mismatch"):
        K.build_checkpoint(spark, root, bundle, proofs, [Source("old", lost, [A], 102), sources[1]], base["snapshot_id"])
    other = frame(spark, close([old[0], envelope(103, A, [(A, 2, 9, 6)], [(A, "51", 7)])], bundle))
    with pytest.raises(ValueError, match="observed fields differ"):
        K.build_checkpoint(spark, root, bundle, proofs, [Source("old", other, [A], 102), sources[1]], base["snapshot_id"])
    assert store.ready_checkpoints(spark, root).count() == ready
    # retention: a pin keeps the base, unpublished candidates go, then the base goes too
    pin = R.pin(spark, root, base["snapshot_id"], "test")
    assert store.stored_snapshots(spark, root).count() > ready
    gone = M.prune_checkpoints(spark, root, 1)
    assert base["snapshot_id"] not in gone and len(gone) >= 1
    assert slots(spark, root, base["snapshot_id"])[(A, 1)] == 7
    assert [r.pin_id for r in R.pins(spark, root).collect()] == [pin["pin_id"]]
    # page through the pinned base
    one = R.page(spark, root, pin["pin_id"], A, None, 1)
    two = R.page(spark, root, pin["pin_id"], A, one["next_cursor"], 1)
    assert [one["storage"], two["storage"]] == [[(w(1), w(7))], [(w(2), w(8))]] and two["next_cursor"] is None
    with pytest.raises(ValueError, match="another checkpoint"):
        from chainfold.operators.paging import token_slot
        token_slot(one["next_cursor"], record["snapshot_id"], A)
    with pytest.raises(ValueError):
        R.page(spark, root, pin["pin_id"], A, None, 0)
    audit = R.audit_reads(spark, root, base["snapshot_id"], A, passes=2, page_size=1)
    assert audit["nonzero_slots"] == 2 and audit["calls"] == 4
    # a missing pinned snapshot stops everything
    stray = store.part(root, store.PINS, "pin_id", "p2")
    store.write_row(spark, stray, ("p2", "lost", 1, ""), store.PIN)
    with pytest.raises(ValueError, match="pinned checkpoint is missing"):
        M.prune_checkpoints(spark, root, 1)
    folders.delete(spark, stray)
    export_and_restore(spark, root, record, proofs, tmp_path)


def export_and_restore(spark, root, record, proofs, tmp_path):
    path = str(tmp_path / "export")
    out = P.export_checkpoint(spark, root, record["snapshot_id"], path, proofs, page_size=1)
    assert out["pages"] == 2
    with pytest.raises(FileExistsError):
        P.export_checkpoint(spark, root, record["snapshot_id"], path, proofs)
    assert P.verify_export(spark, path, record["header"]["hash"])["state_sha256"] == record["state_sha256"]
    with pytest.raises(ValueError, match="another block"):
        P.verify_export(spark, path, w(1))
    fresh = str(tmp_path / "fresh")
    restored = P.import_checkpoint(spark, fresh, path)
    assert restored["restored_from"] == record["snapshot_id"]
    assert slots(spark, fresh, restored["snapshot_id"]) == {(A, 2): 9, (B, 7): 11}
    import glob
    import gzip
    (page,) = glob.glob(f"{path}/pages/*.gz")       # both pages in one file
    text = gzip.open(page, "rt").read()
    first, second = map(json.loads, text.splitlines())
    assert set(first) == {"page", "address", "slot", "value"} and (first["page"], second["page"]) == (0, 1)
    with gzip.open(page, "wt") as f:
        f.write(text.replace(w(9), w(8)))
    for name in glob.glob(f"{path}/pages/.*.crc"):
        folders.delete(spark, name)
    reasons = {r.reason for r in P.layout_violations(spark, path).collect()}
    assert "file size or checksum" in reasons
    with gzip.open(page, "wt") as f:
        f.write(text + text.replace('"value"', '"extra":"1","value"'))
    reasons = {r.reason for r in P.layout_violations(spark, path).collect()}
    assert "pages of a file" not in reasons
    assert {"unexpected fields", "row count", "doubled slot", "unordered slots"} <= reasons
    with pytest.raises(ValueError, match="export layout"):
        P.verify_export(spark, path)
    with gzip.open(f"{path}/pages/part-x.json.gz", "wt") as f:     # a page again in a file nobody declared, and one out of range
        f.write(text.splitlines()[0] + "\n" + text.splitlines()[1].replace('"page":1', '"page":7') + "\n")
    reasons = {r.reason for r in P.layout_violations(spark, path).collect()}
    assert {"page in several files", "unlisted page", "pages of a file"} <= reasons


def test_export_files_hold_bounded_pages(spark, tmp_path, monkeypatch):
    """Pages stay whole in files of at most PAGES_PER_FILE pages; an empty state has no page."""
    monkeypatch.setattr(P, "PAGES_PER_FILE", 4)
    rows = [(a, w(i), w(i + 1)) for a, n in ((A, 61), (B, 3)) for i in range(n)]
    store.write_sorted(spark.createDataFrame(rows, "address string, slot string, value string"), str(tmp_path / "sorted"))
    numbered, facts = P.global_pages(spark.read.parquet(str(tmp_path / "sorted")), 5)
    assert facts.count() == 14 and numbered.count() == 64
    spread = numbered.repartitionById(4, F.floor(F.col("page") / 4).cast("int")).groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("page").alias("low"), F.max("page").alias("high"), F.count_distinct("address").alias("accounts")).orderBy("p").collect()
    assert [(r.low, r.high) for r in spread] == [(0, 3), (4, 7), (8, 11), (12, 13)]


def test_publish_is_last(spark, tmp_path):
    root = str(tmp_path)
    bundle, rows = target(101, {A: (2 ** 63 + 9, 40, "0x", {w(1): w(7), w(2): w(8)})})
    env = frame(spark, close(first_rows(), bundle))

    def crash():
        raise RuntimeError("killed")
    with pytest.raises(RuntimeError):
        K.build_checkpoint(spark, root, bundle, spark.createDataFrame(rows, world.PROOFS), [Source("one", env, [A], 100)],
                           after_accounts=crash)
    assert store.ready_checkpoints(spark, root).count() == 0 and store.stored_snapshots(spark, root).count() == 1
    (left,) = [r.snapshot_id for r in store.stored_snapshots(spark, root).collect()]
    with pytest.raises(LookupError):
        store.manifest(spark, root, left)
    assert M.prune_checkpoints(spark, root, 1) == [left]


def test_interval_defects_stop_a_build(spark, tmp_path):
    bundle, rows = target(101, {A: (2 ** 63 + 9, 40, "0x", {w(1): w(7), w(2): w(8)})})
    good = close(first_rows(), bundle)
    proofs = spark.createDataFrame(rows, world.PROOFS)

    def change(i, **fields):
        names = [f.name for f in S.ENVELOPE.fields]
        row = dict(zip(names, good[i]), **fields)
        return good[:i] + [tuple(row.values())] + good[i + 1:]
    cases = {"missing block": good[1:], "conflicting": good + [good[0][:1] + (w(3),) + good[0][2:]],
             "broken parent": change(1, parent_hash=w(4)), "filter": change(0, accounts=B),
             "schema": change(0, schema_version=2), "producer": change(0, producer_version=6),
             "header": change(1, hash=w(9))}
    for text, bad in cases.items():
        with pytest.raises(ValueError, match=text):
            K.build_checkpoint(spark, str(tmp_path), bundle, proofs, [Source("one", frame(spark, bad), [A], 100)])


def lifecycle_rows():
    return [envelope(1, A, [(A, i, i, i) for i in range(1, 6)]),
            envelope(2, A, [(A, 9, 9, 50)], lifecycle=[(A, "storage_reset", 40)]),
            envelope(3, A, [(A, 9, 0, 1), (A, 2, 22, 2)]),
            envelope(4, A, [(A, 3, 33, 9)], [(A, "5", 2)], lifecycle=[(A, "nonce_reset", 8)])]


def test_compaction_in_chunks_equals_one_pass(spark, tmp_path):
    env = frame(spark, lifecycle_rows())
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    whole = C.compact(spark, one, env, [A], 1)
    for end in (1, 2, 3, 4):
        record = C.compact(spark, many, env.where(F.col("number") >= end - 1), [A], 1, end)
    assert {k: record[k] for k in ("state_sha256", "nonzero_slots", "fields_sha256")} == {
        k: whole[k] for k in ("state_sha256", "nonzero_slots", "fields_sha256")}
    got = {int(r.slot, 16): int(r.value, 16) for r in store.generation_storage(spark, many, record["generation"]).collect()}
    assert got == {2: 22, 3: 33}
    assert folders.partition_values(spark, f"{many}/{store.GENERATIONS}", "generation") == [record["generation"]]
    assert C.compact(spark, many, env, [A], 1)["already_compacted"]
    assert C.isolated_copy(spark, many, str(tmp_path / "copy"))["nonzero_slots"] == 2
    C.compact(spark, str(tmp_path / "early"), env, [A], 1, 2)
    C.isolated_copy(spark, str(tmp_path / "early"), str(tmp_path / "part"), env, 3)
    assert [r.number for r in spark.read.parquet(str(tmp_path / "part" / "blocks")).collect()] == [3]
    report = C.growth_report(spark, many).first()
    assert report["active"] and report["rows"] == 2 and report["bytes"] > 0
    with pytest.raises(ValueError, match="inside a folded prefix"):
        C.load_source(spark, "x", many, env, [A], 2).choice
    with pytest.raises(ValueError, match="already have a checkpoint"):
        C.compact(spark, str(tmp_path / "new"), env, [A], 1, published=spark.createDataFrame([(A,)], "address string"))
    # a damaged generation is found
    path = store.part(many, store.PREFIX_STORAGE, "generation", record["generation"])
    spark.createDataFrame([(A, w(77), w(1))], S.CHECKPOINT_STORAGE).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="differs from its manifest"):
        C.audit_prefix(spark, many)


def test_checkpoint_from_prefix(spark, tmp_path):
    root, prefix = str(tmp_path / "root"), str(tmp_path / "prefix")
    rows = lifecycle_rows()
    C.compact(spark, prefix, frame(spark, rows[:2]), [A], 1)
    bundle, proof = target(4, {A: (0, 5, "0x", {w(2): w(22), w(3): w(33)})})
    env = frame(spark, close(rows, bundle)[2:])
    source = C.load_source(spark, "one", prefix, env, [A], 1)
    record = K.build_checkpoint(spark, root, bundle, spark.createDataFrame(proof, world.PROOFS), [source])
    assert slots(spark, root, record["snapshot_id"]) == {(A, 2): 22, (A, 3): 33}


def test_history_plan(spark, published, tmp_path):
    root, record, _, _ = published
    history = str(tmp_path / "history")
    frame(spark, [envelope(n, A) for n in range(90, 130)]).withColumn(
        "block_date", F.expr("number div 10")).write.partitionBy("block_date").parquet(history)
    accounts = spark.createDataFrame([(A,)], "address string")
    plan = M.history_plan(spark, root, history, accounts, 5)
    assert plan["remove_before"] == 102 and [p["block_date"] for p in plan["partitions"]] == ["9"]
    assert M.history_plan(spark, root, history, accounts, 35)["remove_before"] == 95
    M.prune_history(spark, root, history, accounts, 5)
    assert spark.read.parquet(history).agg(F.min("number")).first()[0] == 100
    with pytest.raises(ValueError, match="no checkpoint"):
        M.history_plan(spark, root, history, spark.createDataFrame([("0xother",)], "address string"), 5)


def test_current_state_verdicts(spark):
    header, rows = world.bundle(9, w(1), {A: (3, 40, "0x6000", {w(1): w(7)})})
    code_hash = rows[0][5]
    head = {"number": 9, "hash": w(1), "state_root": header["state_root"]}
    account = "address string, nonce decimal(20,0), balance string, code_hash string, code string, last_block bigint"
    accounts = spark.createDataFrame([(A, N64(3), "40", code_hash, "0x6000", 9)], account)
    storage = spark.createDataFrame([(A, w(1), w(7), 8), (A, w(2), w(0), 9)], "address string, slot string, value string, last_block bigint")
    proofs = spark.createDataFrame(rows, world.PROOFS)
    assert G.verify_current_state(spark, head, accounts, storage, proofs, True)["status"] == "roots match"
    second = spark.createDataFrame([(A, w(1), w(7))], S.CHECKPOINT_STORAGE)
    got = G.verify_current_state(spark, head, accounts, storage, proofs, False, second)
    assert got["status"] == "sample matches" and got["storage_slots_checked"] == 2
    with pytest.raises(ValueError):
        G.verify_current_state(spark, head, accounts, storage.where("last_block = 9"), proofs, True)
    with pytest.raises(ValueError):
        G.verify_current_state(spark, head, accounts, storage, proofs, False, second.limit(0))
    with pytest.raises(ValueError, match="not usable"):
        G.verify_current_state(spark, {**head, "number": 8}, accounts, storage, proofs, True)
    assert G.compare_states(storage, storage)["equal"] and not G.compare_states(storage, storage.limit(1))["equal"]


def test_onboarding(spark, published):
    """A late cohort may join on a short interval only with proven-empty storage."""
    from chainfold.plans.onboarding import join_cohorts
    root, base, _, base_bundle = published
    parent = base_bundle["header"]["hash"]

    def attempt(slots_of_b):
        bundle, rows = target(102, {A: (2 ** 63 + 9, 40, "0x", {w(1): w(7), w(2): w(8)}), B: (4, 0, "0x", slots_of_b)})
        old = frame(spark, close([envelope(102, A, parent_hash=parent)], bundle))
        new = frame(spark, close([envelope(101, B, nonces=[(B, N64(4), 1)], hash=parent), envelope(102, B, parent_hash=parent)], bundle))
        return join_cohorts(spark, root, bundle, spark.createDataFrame(rows, world.PROOFS), base["snapshot_id"],
                            [Source("old", old, [A], 102)], [Source("new", new, [B], 101)])
    record = attempt({})
    assert record["account_count"] == 2 and slots(spark, root, record["snapshot_id"]) == {(A, 1): 7, (A, 2): 8}
    with pytest.raises(ValueError, match="needs its whole history"):
        attempt({w(1): w(1)})


def test_pages_over_many_files(spark, tmp_path):
    root = str(tmp_path)
    rows = [(a, w(i * 3), w(i + 1)) for a in (A, B) for i in range(200)]
    path = store.part(root, store.STORAGE, "snapshot_id", "s")
    spark.createDataFrame(rows, S.CHECKPOINT_STORAGE).repartitionByRange(9, "address", "slot").sortWithinPartitions(
        "address", "slot").write.parquet(path)
    store.write_index(spark, root, "s")
    from chainfold.operators.paging import keyset_rows
    for limit in (1, 7, 64, 500):
        after, got = "", []
        while True:
            files = store.page_storage(spark, root, "s", A, after, limit + 1)
            page = [r.slot for r in keyset_rows(files, A, after, limit).collect()]
            got += page[:limit]
            if len(page) <= limit or limit < 7 and len(got) >= 5:
                break
            after = got[-1]
        assert got == [w(i * 3) for i in range(200)][:len(got)] and (limit < 7 or len(got) == 200)
    assert len(store.page_storage(spark, root, "s", A, w(300), 8).inputFiles()) <= 2
    assert store.page_storage(spark, root, "s", "0xnone", "", 8).count() == 0


def test_tables_and_logs(spark, tmp_path):
    from builders import block, call, code, frame as blocks_of, nonce, storage, tx, w as word32
    from chainfold.plans import tables as T
    from chainfold.streaming import current
    one = block(100, system_calls=[call(storage_changes=[storage(4, 9, b"\x08", b"\x05", key=b"\x01")])],
                transaction_traces=[tx(calls=[call(nonce_changes=[nonce(4, 5, 1)], code_changes=[code(4, 6)])])])
    two = block(205, system_calls=[call(storage_changes=[storage(4, 2, b"\x05", b"", key=b"\x01")])])
    first, second = T.project_tables(blocks_of(spark, one)), T.project_tables(blocks_of(spark, two))
    assert set(first) == {"blocks", "storage", "accounts", "code", *T.LOG_KEYS}
    path = str(tmp_path / "log")
    for batch, out in ((0, first), (1, second), (1, second), (2, first)):      # a repeat and a second delivery
        T.append_log(out["storage_changes"], path, batch, 100)
    log = T.read_log_table(spark, path, "storage_changes")
    assert sorted((r.block_num, r.ordinal, r.block_bucket) for r in log.collect()) == [(100, 9, 100), (205, 2, 200)]
    part = T.read_log_table(spark, path, "storage_changes", 200, 299, 100)
    assert [r.block_num for r in part.collect()] == [205]
    plan = part._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(block_bucket" in plan
    folder = str(tmp_path / "state")
    for batch, out in ((0, second), (1, first)):                                # older block arrives later
        top = out["blocks"].selectExpr("block_num", "block_num AS number", "block_hash AS hash", "state_root")
        current.merge_batch(spark, folder, batch, out["storage"], out["accounts"], top)
    state = current.read_current(spark, folder)
    assert state["head"].first().number == 205 and int(state["storage"].first().value, 16) == 0
    assert state["accounts"].first().nonce == 2
