import world
from chainfold.operators import proofs as V

A, B, GHOST = ("0x" + c * 40 for c in "abc")
STATE = {A: (2 ** 63 + 9, 10 ** 60, "0x6000", {"0x" + "00" * 31 + "01": "0x" + "00" * 31 + "07"}),
         B: (1, 0, "0x", {}), GHOST: (0, 0, "0x", {}), **{f"0x{i:040x}": (i, i * 7, "0x", {}) for i in range(1, 30)}}


def audit(spark, rows, root):
    return {r.address: r for r in V.audit_proofs(spark.createDataFrame(rows, world.PROOFS).drop("code"), root).collect()}


def test_presence_absence_and_wrong_claims(spark):
    header, rows = world.bundle(7, "0x" + "22" * 32, STATE)
    got = audit(spark, rows, header["state_root"])
    assert all(r.error is None for r in got.values())
    assert got[A].exists and int(got[A].nonce) == 2 ** 63 + 9 and got[A].balance == str(10 ** 60)
    assert not got[GHOST].exists
    by = {r[0]: r for r in rows}
    cases = {
        "nonce": by[A][:2] + ("0x1",) + by[A][3:],
        "balance": by[A][:3] + ("0x0",) + by[A][4:],
        "code": by[A][:5] + ("0x" + "33" * 32,) + by[A][6:],
        "cut": by[A][:6] + (by[A][6][:-1],) + by[A][7:],
        "extra": by[A][:6] + (by[A][6] + by[A][6][-1:],) + by[A][7:],
        "other": by[A][:1] + (B,) + by[A][2:],
        "hex": by[A][:2] + ("12",) + by[A][3:],
        "wide": by[A][:2] + ("0x1" + "0" * 16,) + by[A][3:],
        "ghost": by[GHOST][:2] + ("0x5",) + by[GHOST][3:],
        "none": by[A][:6] + ([],) + by[A][7:],
    }
    for name, row in cases.items():
        (only,) = audit(spark, [row], header["state_root"]).values()
        assert only.error, name
    assert audit(spark, rows[:1], "0x" + "44" * 32)[A].error


def test_headers(spark):
    header = {"number": 9, "parent_hash": "0x" + "11" * 32, "state_root": "0x" + "55" * 32, "timestamp": 77, "hash": ""}
    encoded = world.encoded_header(header)
    schema = ("number bigint, hash string, parent_hash string, state_root string, timestamp bigint, header_rlp string, "
              "expected_hash string")
    good = (9, header["hash"], header["parent_hash"], header["state_root"], 77, encoded, None)

    def error(row):
        return V.audit_headers(spark.createDataFrame([row], schema)).first().error
    assert error(good) is None and error(good[:6] + (header["hash"],)) is None
    assert "expected hash" in error(good[:6] + ("0x" + "00" * 32,))
    assert "summary" in error((8,) + good[1:])
    assert "summary" in error(good[:4] + (78,) + good[5:])
    assert "block hash" in error((9, "0x" + "66" * 32) + good[2:])
    assert "trailing" in error(good[:5] + (encoded + "00", None))
    assert error(good[:5] + (encoded[:-2], None)) and error(good[:5] + ("0xc0", None))


def test_encode_headers(spark):
    raw = {"parentHash": "0x" + "11" * 32, "sha3Uncles": "0x" + "07" * 32, "miner": "0x" + "07" * 20,
           "stateRoot": "0x" + "55" * 32, "transactionsRoot": "0x" + "07" * 32, "receiptsRoot": "0x" + "07" * 32,
           "logsBloom": "0x" + "07" * 256, "difficulty": "0x2", "number": "0x9", "gasLimit": "0x1e", "gasUsed": "0x15",
           "timestamp": "0x4d", "extraData": "0x78", "mixHash": "0x" + "07" * 32, "nonce": "0x" + "07" * 8}
    header = {"number": 9, "parent_hash": raw["parentHash"], "state_root": raw["stateRoot"], "timestamp": 77, "hash": ""}
    want = world.encoded_header(header)
    df = spark.createDataFrame([{**raw, "hash": header["hash"]}])
    got = V.encode_headers(df).first()
    assert got.error is None and got.header_rlp == want
    assert V.encode_headers(spark.createDataFrame([{**raw, "hash": "0x" + "00" * 32}])).first().error
    del raw["miner"]
    assert "miner" in V.encode_headers(spark.createDataFrame([{**raw, "hash": header["hash"]}])).first().error


def test_metadata(spark):
    header, rows = world.bundle(7, "0x" + "22" * 32, STATE)
    proofs = spark.createDataFrame(rows, world.PROOFS)
    proven = V.audit_proofs(proofs.drop("code"), header["state_root"])
    stored = proven.join(proofs.select("address", "code"), "address").select("address", "nonce", "balance", "code_hash", "code")
    assert V.metadata_mismatches(stored, proven).count() == 0
    wrong = stored.selectExpr("address", "nonce", "balance", "code_hash", f"IF(address = '{A}', '0x60', code) AS code")
    assert [(r.address, r.field) for r in V.metadata_mismatches(wrong, proven).collect()] == [(A, "code")]
