import pytest
from pyspark.sql import functions as F

from builders import block, call, code, frame, nonce, storage, tx, w
from chainfold import schema as S
from chainfold.functions import scalars as X, uint256 as U
from chainfold.operators import current_state as C, persistence as P, telemetry as T
from chainfold.sources import blocks as B, files, folders


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_words_and_quantities(spark):
    assert one(spark, X.word(F.lit(b"\x01"))) == "0x" + "0" * 63 + "1"
    assert one(spark, X.hex_text(F.lit(b"\xab\x01"))) == "0xab01" and one(spark, X.bytea_text(F.lit(b"\x01"))) == "\\x01"
    assert int(one(spark, X.quantity_u64(F.lit("0xffffffffffffffff")))) == 2 ** 64 - 1
    assert int(one(spark, X.quantity_u64(F.lit("0x00ff")))) == 255 and one(spark, X.quantity_u64(F.lit("0x0"))) == 0
    assert one(spark, X.quantity_u64(F.lit("0x10000000000000000"))) is None and one(spark, X.quantity_u64(F.lit("ff"))) is None
    big = 2 ** 256 - 1
    df = spark.createDataFrame([(hex(big),), ("0x0",), (hex(big + 1),), ("0xg",), (None,), ("12",)], "q string")
    assert [r.x for r in df.select(U.quantity_to_decimal(F.col("q")).alias("x")).collect()] == [str(big), "0", None, None, None, None]
    raw = spark.createDataFrame([(b"\xff" * 32,), (b"",), (None,), (b"\x00\x05",)], "b binary")
    assert [r.x for r in raw.select(U.bytes_to_decimal("b").alias("x")).collect()] == [str(big), "0", "0", "5"]
    exact = spark.createDataFrame([("0",), ("12",), ("01",), ("",), ("-1",), (str(2 ** 64 - 1),), (str(2 ** 64),)], "t string")
    assert [r.x for r in exact.select(X.is_exact_uint64("t").alias("x")).collect()] == [True, True, False, False, False, True, False]
    order = [r.t for r in spark.createDataFrame([("9",), ("10",), (str(10 ** 60),)], "t string").orderBy(F.desc(X.decimal_order("t"))).collect()]
    assert order == [str(10 ** 60), "10", "9"]
    with pytest.raises(Exception, match="invalid address"):
        one(spark, X.canonical_address(F.lit("0x12")))
    with pytest.raises(Exception, match="invalid hex"):
        one(spark, X.to_bytes(F.lit("0x123")))


def test_text_forms(spark):
    assert one(spark, X.canonical_json(b=F.lit(1), a=F.lit("x"), c=F.lit(None).cast("string"))) == '{"a":"x","b":1,"c":null}'
    token = one(spark, X.url_token(F.lit("??>>~~" * 30)))
    assert "+" not in token and "/" not in token and "\n" not in token
    assert one(spark, X.url_token_text(F.lit(token))) == "??>>~~" * 30
    kept = one(spark, X.keys_with_prefix(F.create_map(F.lit("ExternalA"), F.lit(1), F.lit("Other"), F.lit(2)), "External"))
    assert kept == {"ExternalA": 1}
    assert one(spark, X.month_partition(F.lit("2024-03-09").cast("date"))) == 202403
    assert str(one(spark, X.day_partition(F.lit(86400)))) == "1970-01-02"
    assert one(spark, X.manifest_fields(F.lit('{"n":3,"x":1}'), "n bigint")).n == 3


def test_nested_arrays_roundtrip_and_damage(spark):
    row = (1, "h", "p", 1, "r", 5, "a", 1, [("a", "s", "v", 1), ("a", "t", "u", 2)], [], [("a", None, 3)], [], [("a", "k", 1)])
    env = spark.createDataFrame([row], S.ENVELOPE)
    wire = B.parallel_arrays(env)
    assert "storage.slot" in wire.columns
    assert B.zip_arrays(wire).select(*env.columns).collect() == env.collect()
    assert [r.slot for r in B.unnest(env, "storage").collect()] == ["s", "t"]
    damaged = wire.withColumn("storage.value", F.array(F.lit("v")))
    with pytest.raises(Exception, match="malformed nested arrays"):
        B.zip_arrays(damaged).collect()


def test_blocks_and_envelopes_from_files(spark, tmp_path):
    source = frame(spark, block(), block(101))
    source.write.parquet(str(tmp_path / "p"))
    source.write.json(str(tmp_path / "j"))
    for form, path in (("parquet", "p"), ("json", "j")):
        got = B.read_blocks(spark, str(tmp_path / path), form)
        assert got.schema == S.BLOCK and sorted(r.number for r in got.collect()) == [100, 101]
    rows = [(5, "a", 1, 1, False), (5, "a", 2, 2, False), (6, "b", 1, 1, False), (6, "b", 0, 2, True), (7, "c", 1, 1, False)]
    spark.createDataFrame(rows, "number bigint, hash string, timestamp bigint, _version_ bigint, _deleted_ boolean").write.parquet(
        str(tmp_path / "e"))
    got = B.read_envelopes(spark, str(tmp_path / "e"), 5, 6).collect()
    assert [(r.number, r.timestamp) for r in got] == [(5, 2)]
    plan = B.read_envelopes(spark, str(tmp_path / "e"), 5, 6)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(number,5)" in plan


LOG = """2026-01-01T00:00:00Z INFO session initialized with remote endpoint {"max_parallel_workers": 5, "trace_id": "t", "more": 1}
2026-01-01T00:00:01Z INFO sink settings {"decode_workers": 2}
2026-01-01T00:00:02Z INFO stream stats {"progress_running_jobs": {"0": 3, "1": 4}, "progress_total_processed_blocks": 10}
2026-01-01T00:00:03Z INFO stream stats {"is_live": true}
2026-01-01T00:00:04Z INFO stream stats {"progress_running_jobs": {"0": 2}}
2026-01-01T00:00:05Z INFO other line {"a": 1}
stream stats without payload
"""


def test_log_lines(spark, tmp_path):
    path = tmp_path / "run.log"
    path.write_text(LOG)
    read = lambda shape: files.read_log(spark, str(path), shape)
    assert [(r.timestamp, r.max_parallel_workers, r.linear_handoff_block) for r in read("session").collect()] == [
        ("2026-01-01T00:00:00Z", 5, None)]
    assert [r.decode_workers for r in read("setting").collect()] == [2]
    rolled = T.telemetry_rollup(read("progress")).first()
    assert (rolled.max_running_jobs, rolled.last_processed) == (7, 10)
    quiet = T.telemetry_rollup(read("progress").where("is_live")).first()
    assert (quiet.max_running_jobs, quiet.last_processed) == (None, None)     # unknown stays unknown
    path.write_text("t INFO stream stats {broken\n")
    with pytest.raises(Exception):
        read("progress").collect()


def test_json_documents_and_series(spark, tmp_path):
    (tmp_path / "m.json").write_text('{\n "a": 1,\n "b": "x"}')
    assert files.json_document(spark, str(tmp_path / "m.json"), "a bigint, b string").first().b == "x"
    (tmp_path / "bad.json").write_text('{"a": "no"}')
    with pytest.raises(Exception):
        files.json_document(spark, str(tmp_path / "bad.json"), "a bigint").collect()
    series = str(tmp_path / "series")
    for n in (1, 2):
        files.append_rows(spark.createDataFrame([("c", n)], "cohort string, at bigint"), series)
    rows = files.json_rows(spark, series, "cohort string, at bigint")
    assert T.latest_record(rows, ["cohort"], "at").first().at == 2
    (tmp_path / "open.jsonl").write_text('{"at": 1}\n{"at": 2')
    assert [r.at for r in files.complete_rows(spark, str(tmp_path / "open.jsonl"), "at bigint").collect()] == [1]


def test_page_problems(spark):
    good = '{"page":3,"address":"a","slot":"0x%064x","value":"0x%064x"}' % (1, 2)
    lines = [good, good[:-1] + ',"x":1}', '{"page":3,"address":"a","slot":"0x1","value":"0x2"}', "{", good + " " * 1000,
             good.replace("3", "-3", 1), good.replace('"page":3,', "")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = [r.p for r in df.select("i", files.page_problem().alias("p")).orderBy("i").collect()]
    assert got == [None, "unexpected fields", "malformed word", "unexpected fields", "oversized row",
                   "malformed page number", "unexpected fields"]


def test_event_log_and_tables(spark):
    b = block(system_calls=[call(storage_changes=[storage(4, 9, b"\x08", b"", key=b"\x01")])],
              transaction_traces=[tx(index=3, calls=[call(
                  index=2, nonce_changes=[nonce(4, 5, 1)], code_changes=[code(4, 6), code(5, 7), code(5, 8, w(9), b"", b"")])])])
    persisted = P.persisted_blocks(frame(spark, b, block(101)))
    changes = {k: P.changes_of(persisted, k) for k in ("storage", "balances", "nonces", "codes")}
    log = C.event_log(persisted, "storage", changes["storage"]).first()
    assert (log.scope, log.tx_hash, log.slot, log.block_num) == ("system_call", "", "0x" + "0" * 63 + "1", 100)
    nonces = C.event_log(persisted, "nonces", changes["nonces"]).first()
    assert (nonces.scope, nonces.tx_hash, nonces.tx_index, nonces.call_index) == ("tx", "0x" + "07" * 32, 3, 2)
    rows = {r.block_num: r for r in C.block_rows(persisted).collect()}
    assert (rows[100].storage_changes, rows[100].code_changes, rows[101].storage_changes) == (1, 3, 0)
    stored = C.distinct_code(changes["codes"]).collect()
    assert [(bytes(r.code), r.size, r.first_block_num) for r in stored] == [(b"\xef\x01\x00", 3, 100)]
    named = changes["codes"].withColumn("address", X.hex_text("address")).withColumn("new_hash", X.hex_text("new_hash"))
    accounts = C.current_accounts(changes["balances"].withColumn("address", X.hex_text("address")), changes["nonces"].withColumn("address", X.hex_text("address")), named)
    got = {r.address[-2:]: r for r in C.account_state(accounts, C.distinct_code(named)).collect()}
    assert got["04"].nonce == 2 and got["04"].code == "0xef0100" and got["05"].code is None and got["05"].balance is None


def test_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(path)
    assert folders.partition_values(spark, path, "k") == ["0", "1"] and folders.written(spark, path)
    assert folders.delete(spark, path) and not folders.exists(spark, path) and not folders.delete(spark, path)
