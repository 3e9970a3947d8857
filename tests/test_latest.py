import random

import pytest
from pyspark.sql import functions as F

from chainfold.functions import scalars as X
from chainfold.operators import continuity as N, current_state as C, latest as L, quality as Q

CHANGE = "number bigint, ordinal bigint, address string, slot string, value string"
RESET = "number bigint, ordinal bigint, address string"


def word(n):
    return f"0x{n:064x}"


@pytest.fixture(scope="module")
def history():
    rng = random.Random(5)
    changes, resets = [], []
    for number in range(40):
        for ordinal in range(rng.randint(0, 12)):
            address = "0xhot" if rng.random() < .5 else rng.choice("abc")
            if rng.random() < .06:
                resets.append((number, ordinal, address))
            else:
                changes.append((number, ordinal, address, word(rng.randint(1, 9)), word(rng.choice([0, 0, 3, 4, 5]))))
    return changes, resets


def brute(changes, resets, end=10 ** 9):
    state, cut = {}, {}
    for n, o, a in resets:
        if n <= end:
            cut[a] = max(cut.get(a, (-1, -1)), (n, o))
    for n, o, a, s, v in sorted(changes):
        if n <= end:
            state[(a, s)] = ((n, o), v)
    return {k: v for k, (p, v) in state.items() if p > cut.get(k[0], (-1, -1)) and v != word(0)}


def as_dict(df):
    return {(r.address, r.slot): r.value for r in df.collect()}


def test_state_is_order_and_copy_independent(spark, history):
    changes, resets = history
    want = brute(changes, resets)
    shuffled = changes + changes[::3]
    random.Random(1).shuffle(shuffled)
    ch, rs = spark.createDataFrame(shuffled, CHANGE).repartition(5), spark.createDataFrame(resets, RESET)
    assert as_dict(L.reduce_state(ch, rs)) == want
    for end in (0, 7, 23):
        assert as_dict(L.state_as_of(ch, rs, end)) == brute(changes, resets, end)
    many = L.state_as_of_each(ch, rs, [23, 7, 39]).where(F.col("value") != X.ZERO_WORD).collect()
    for end in (7, 23, 39):
        assert {(r.address, r.slot): r.value for r in many if r.target == end} == brute(changes, resets, end)


def test_every_slot_has_a_value_at_every_target(spark):
    """A slot that is cleared, reset, not yet written or first written behind the last target reads as zero there."""
    word = lambda n: f"0x{n:064x}"
    changes = spark.createDataFrame([(1, 0, "a", "s", word(1)), (5, 0, "a", "s", X.ZERO_WORD), (2, 0, "b", "s", word(2)),
                                     (9, 0, "c", "late", word(3))], CHANGE)
    got = L.state_as_of_each(changes, spark.createDataFrame([(4, 0, "b")], RESET), [3, 6]).collect()
    assert {(r.target, r.address, r.slot): r.value for r in got} == {
        (3, "a", "s"): word(1), (6, "a", "s"): X.ZERO_WORD, (3, "b", "s"): word(2), (6, "b", "s"): X.ZERO_WORD,
        (3, "c", "late"): X.ZERO_WORD, (6, "c", "late"): X.ZERO_WORD}


def test_chunked_folds_equal_one_pass(spark, history):
    changes, resets = history
    ch, rs = spark.createDataFrame(changes, CHANGE), spark.createDataFrame(resets, RESET)
    state, at = None, -1
    for end in (5, 17, 18, 39):
        part, cuts = L.up_to(ch, end).where(F.col("number") > at), L.up_to(rs, end).where(F.col("number") > at)
        folded = [(state, at)] if state is not None else []
        state, at = L.reduce_state(L.union_changes([part], folded), cuts).select("address", "slot", "value"), end
    assert as_dict(state) == brute(changes, resets)


def test_hot_address_join_may_split(spark, history):
    """The reset join is an ordinary equi join: AQE may broadcast or split it, no cross join appears."""
    changes, resets = history
    df = L.reduce_state(spark.createDataFrame(changes, CHANGE), spark.createDataFrame(resets, RESET))
    plan = df._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_unknown_fields_stay_unknown(spark):
    at = "number bigint, ordinal bigint, address string, "
    balances = spark.createDataFrame([(5, 1, "a", "10"), (7, 1, "a", "0")], at + "value string")
    nonces = spark.createDataFrame([(6, 2, "a", 3)], at + "value int")
    codes = spark.createDataFrame([(1, 1, "b", "0xh", "0x60")], at + "hash string, code string")
    rows = L.field_rows(balances, nonces, codes)
    got = {r.address: r for r in L.latest_fields(rows, keep_blocks=True).collect()}
    assert (got["a"].balance, got["a"].nonce, got["a"].code, got["a"].last_block) == ("0", 3, None, 7)
    assert (got["b"].balance, got["b"].code_hash) == (None, "0xh")
    base = spark.createDataFrame([("a", "99", None, "0xold", "0xaa")],
                                 "address string, balance string, nonce decimal(20,0), code_hash string, code string")
    over = {r.address: r for r in L.overlay_fields(base, [], rows).collect()}
    assert (over["a"].balance, over["a"].nonce, over["a"].code_hash) == ("0", 3, "0xold")


def test_prefix_choice():
    prefix = {"start_block": 10, "number": 20}
    assert L.choose_prefix(21, prefix) == {"use_prefix": False, "delta_start": 21}
    assert L.choose_prefix(10, prefix) == {"use_prefix": True, "delta_start": 21}
    with pytest.raises(ValueError):
        L.choose_prefix(15, prefix)


def test_merge_keeps_newer_block_and_other_fields(spark):
    old = spark.createDataFrame([("a", word(1), word(5), 9, 1)], "address string, slot string, value string, block_num bigint, ordinal bigint")
    late = spark.createDataFrame([("a", word(1), word(4), 8, 7)], old.schema)
    assert C.merge_storage(old, late).first().value == word(5)
    account = "address string, balance string, nonce decimal(20,0), code_hash string, block_num bigint, balance_block_num bigint, nonce_block_num bigint, code_block_num bigint"
    known = spark.createDataFrame([("a", "5", None, "0xh", 9, 9, None, 3)], account)
    batch = spark.createDataFrame([("a", "7", None, None, 8, 8, None, None)], account)
    got = C.merge_accounts(known, batch).first()
    assert (got.balance, got.code_hash, got.block_num, got.nonce) == ("5", "0xh", 9, None)


def test_range_rules(spark):
    assert N.check_range(3, 5) == (3, 4)
    for bad in ((5, 5), (5, 4), (-1, 2)):
        with pytest.raises(ValueError):
            N.check_range(*bad)


def test_expected_and_quiet_changes(spark):
    seen = spark.createDataFrame([(1, "code_cleared"), (1, "code_cleared")], "ordinal int, kind string")
    want = spark.createDataFrame([(1, "code_cleared"), (2, "nonce_reset")], "ordinal int, kind string")
    got = {(r.ordinal, r.kind): r.surplus for r in Q.multiset_differences(seen, want, ["ordinal", "kind"]).collect()}
    assert got == {(1, "code_cleared"): 1, (2, "nonce_reset"): -1}
    sides = spark.createDataFrame([("a", "code", "equal", "x", "y"), ("b", "code", "different", "x", "y"),
                                   ("c", "code", "different", None, None)],
                                  "address string, field string, must string, before string, after string")
    assert {r.address for r in Q.side_claims(sides, ["code"]).collect()} == {"a", "c"}


def test_call_chains(spark):
    from chainfold.operators.block_end import execution_accounts
    depth = 70
    rows = [(1, i, i - 1 if i else None, i > 0, f"c{i}") for i in range(depth)]
    rows += [(2, 1, 9, True, "x"), (3, 1, 2, True, "p"), (3, 2, 1, True, "q"), (4, 5, 5, True, "self")]
    got = {(r.tx, r["index"]): r.account for r in execution_accounts(spark.createDataFrame(
        rows, "tx int, index int, parent_index int, delegated boolean, address string")).collect()}
    assert all(got[(1, i)] == "c0" for i in range(depth))
    assert got[(2, 1)] is None and got[(3, 1)] is None and got[(3, 2)] is None and got[(4, 5)] is None
