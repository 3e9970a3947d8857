import pytest

from builders import addr, block, call, code, frame, nonce, storage, tx, w
from chainfold.operators import block_end as E

ACCOUNT = "0x" + "04" * 20


def build(spark, b, accounts=ACCOUNT):
    return E.block_state(frame(spark, b), accounts).collect()[0]


def destroy(seconds, created, ver=5):
    return block(seconds=seconds, ver=ver, transaction_traces=[tx(end_ordinal=40, calls=[call(
        index=1, address=addr(4), suicide=True, call_type=5 if created else 1, begin_ordinal=3, end_ordinal=30,
        storage_changes=[storage(4, 25, b"", b"\x07", key=b"\x01")])])])


def kinds(row):
    return [e.kind for e in row.lifecycle]


def test_empty_block_keeps_identity(spark):
    row = build(spark, block(), f"{ACCOUNT},{ACCOUNT}")
    assert row.accounts == ACCOUNT and row.number == 100 and row.hash == "0x" + "02" * 32
    assert row.storage == [] and row.balances == [] and row.lifecycle == []
    with pytest.raises(ValueError):
        build(spark, block(), "")


def test_collapse_by_ordinal_pads_and_keeps_zero(spark):
    key1 = bytes(31) + b"\x01"
    changes = [storage(4, 9, b"\x08", b"", key=b"\x01"), storage(4, 3, b"\x08", b"\x02", key=bytes(32)),
               storage(4, 4, b"\x08", b"\x03", key=key1)]
    row = build(spark, block(system_calls=[call(storage_changes=changes)]))
    assert len(row.storage) == 2 and row.storage[1].ordinal == 9 and int(row.storage[1].value, 16) == 0
    changes[0]["key"] = b"\x01" * 33
    with pytest.raises(Exception, match="32 bytes"):
        build(spark, block(system_calls=[call(storage_changes=changes)]))


def test_fork_boundary(spark):
    fork = E.DELETION_FORK_TIME
    for ver in (3, 5):
        for seconds, created, gone in ((fork - 1, False, True), (fork, False, False), (fork, True, True)):
            row = build(spark, destroy(seconds, created, ver))
            assert ("storage_reset" in kinds(row)) == gone and (row.storage == []) == gone
            if gone:
                assert row.nonces[0].value == 0 and row.nonces[0].ordinal == 40
                assert row.balances[0].value == "0" and row.codes[0].code == "0x"
            else:
                assert row.nonces == [] and row.codes == []


def test_delegated_destroy_hits_execution_account(spark):
    for kind in (2, 3):
        b = destroy(E.DELETION_FORK_TIME - 1, False)
        calls = b["transaction_traces"][0]["calls"]
        calls[0]["suicide"] = False
        calls.append(call(index=2, parent_index=1, address=addr(8), call_type=kind, suicide=True,
                          begin_ordinal=10, end_ordinal=20))
        row = build(spark, b, f"{ACCOUNT},0x{'08' * 20}")
        assert row.storage == [] and [c.address for c in row.codes] == [ACCOUNT]
        assert {e.address for e in row.lifecycle} == {ACCOUNT}
        calls[1]["parent_index"] = 99
        with pytest.raises(Exception, match="execution context"):
            build(spark, b)


def test_recreation_in_same_block_survives(spark):
    b = destroy(E.DELETION_FORK_TIME - 1, False)
    b["transaction_traces"].append(tx(end_ordinal=80, calls=[call(
        index=1, call_type=5, address=addr(4), begin_ordinal=50, end_ordinal=79,
        storage_changes=[storage(4, 60, b"", b"\x09", key=b"\x02")], nonce_changes=[nonce(4, 55, 0, 1)],
        code_changes=[code(4, 75, body=b"\x60\x00")])]))
    row = build(spark, b)
    assert [s.slot[-1] for s in row.storage] == ["2"] and row.nonces[0].value == 1
    assert row.codes[0].code == "0x6000" and row.balances[0].value == "0"


def test_earlier_creation_and_reverted_destroy_do_not_wipe(spark):
    b = destroy(E.DELETION_FORK_TIME, False)
    b["transaction_traces"].insert(0, tx(end_ordinal=2, calls=[call(call_type=5, address=addr(4))]))
    assert "storage_reset" not in kinds(build(spark, b))
    b = destroy(E.DELETION_FORK_TIME - 1, False)
    b["transaction_traces"][0]["status"] = 3
    assert kinds(build(spark, b)) == []
    b["transaction_traces"][0]["status"] = 1
    b["transaction_traces"][0]["calls"][0]["state_reverted"] = True
    assert kinds(build(spark, b)) == []


def test_system_destroy_and_unreliable_end_fail(spark):
    with pytest.raises(Exception, match="system execution"):
        build(spark, block(transaction_traces=destroy(0, False)["transaction_traces"],
                           system_calls=[call(suicide=True)]))
    b = destroy(0, False)
    b["transaction_traces"][0]["end_ordinal"] = 30
    with pytest.raises(Exception, match="reliable transaction end"):
        build(spark, b)


def test_markers(spark):
    b = block(system_calls=[call(nonce_changes=[nonce(4, 5, 9, 1)],
                                 code_changes=[code(4, 6, w(9), b"", b"")])])
    row = build(spark, b)
    assert [(e.kind, e.ordinal) for e in row.lifecycle] == [("nonce_reset", 5), ("code_cleared", 6)]
    assert row.codes[0].hash == "0xc5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
