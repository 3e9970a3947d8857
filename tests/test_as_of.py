"""State at asked blocks and tables of accounts, against plain Python and against lists."""

import random

import pytest
from pyspark.sql import functions as F

from builders import addr, auth, balance, block, call, code, frame, nonce, storage, tx
from chainfold.functions import scalars as X
from chainfold.operators import account_table as T, as_of as A, block_end as E, ordered as O, persistence as P

ZERO = X.ZERO_WORD


@pytest.fixture(scope="module")
def history():
    """One account has most changes; ties, resets in the same block and requests before, at and after every change."""
    draw = random.Random(8)
    pick = lambda: draw.choice(["hot"] * 6 + ["a", "b", None])
    changes = [(draw.randrange(40), i % 7, pick(), f"s{draw.randrange(4)}", f"v{i}") for i in range(900)]
    changes = list({(c[0], c[1], c[2], c[3]): c for c in changes}.values())
    resets = [(draw.randrange(40), draw.randrange(7), pick()) for _ in range(12)]
    asked = [(i, pick(), f"s{draw.randrange(5)}", draw.randrange(-2, 45), "tag") for i in range(400)]
    return changes, resets, asked + asked[:5]


def test_values_as_of(spark, history):
    changes, resets, asked = history
    frames = [spark.createDataFrame(rows, schema).repartition(6) for rows, schema in (
        (changes, "number bigint, ordinal bigint, address string, slot string, value string"),
        (resets, "number bigint, ordinal bigint, address string"),
        (asked, "event bigint, address string, slot string, block bigint, value_of string"))]

    def brute(address, slot, at, cuts):
        seen = [((n, o), v) for n, o, a, s, v in changes if (a, s) == (address, slot) and n <= at]
        cut = max(((n, o) for n, o, a in cuts if a == address and n <= at), default=(-1, -1))
        best = max(seen, default=None)
        return best[1] if best and best[0] > cut else ZERO
    for given, cuts in ((frames[1], resets), (None, [])):
        got = sorted(((r.event, r.value) for r in A.values_as_of(frames[0], given, frames[2]).collect()))
        assert got == sorted((e, brute(a, s, at, cuts)) for e, a, s, at, _ in asked)
    out = A.values_as_of(frames[0].limit(0), frames[1].limit(0), frames[2])
    assert out.columns == [*frames[2].columns, "value"] and {r.value for r in out.collect()} == {ZERO}
    assert A.values_as_of(*frames[:2], frames[2].limit(0)).count() == 0


def test_last_known_hands_on_over_empty_ranges(spark):
    rows = [("g", i, "first" if i == 0 else None) for i in range(2000)] + [("h", i, None) for i in range(5)]
    got = O.last_known(spark.createDataFrame(rows, "g string, o int, v string").repartition(5), ["g"], ["o"], "v", "seen")
    assert {(r.g, r.seen) for r in got.collect()} == {("g", "first"), ("h", None)} and got.count() == 2005


def blocks(spark):
    return frame(spark, *[block(number=n, transaction_traces=[tx(index=1, type=4, end_ordinal=90, sender=n % 7, set_code_authorizations=[
        auth(n % 9), auth(n % 4, discarded=True)], calls=[call(
            begin_ordinal=2, end_ordinal=80, suicide=n % 3 == 0, address=addr(n % 5), call_type=5 if n % 2 else 1,
            storage_changes=[storage(n % 11, 3, b"", b"\x07", key=bytes([n]))], balance_changes=[balance(n % 6, 7, 4, 1, 2)],
            nonce_changes=[nonce(n % 8, 5, n, n - 1)], code_changes=[code(n % 5, 6, body=b"" if n % 2 else b"\x60")])])]) for n in range(1, 40)])


def test_a_table_of_accounts_equals_a_list(spark):
    source, chosen = blocks(spark), ["0x" + addr(b).hex() for b in (1, 4, 5, 200)]
    table = spark.createDataFrame([(a,) for a in chosen + chosen[:1]] + [(None,)], "address string")
    listed, joined = P.granular_changes(source, ",".join(chosen)), P.granular_changes(source, table)
    for kind in listed:
        assert sorted(map(repr, listed[kind].collect())) == sorted(map(repr, joined[kind].collect())), kind
        assert listed[kind].count() > 0
    one, two = (E.block_state(source, a).orderBy("number").collect() for a in (",".join(chosen), table))
    assert [r.asDict() | {"accounts": ""} for r in one] == [r.asDict() | {"accounts": ""} for r in two]
    assert {r.accounts for r in two} == {two[0].accounts} and two[0].accounts.startswith("table:5:")
    nothing = P.granular_changes(source, table.limit(0))
    assert all(rows.count() == 0 for rows in nothing.values())


def test_the_bitmap_alone_drops_most_of_the_others(spark):
    table = spark.createDataFrame([(f"0x{i:040x}",) for i in range(200)], "address string")
    other = spark.range(5000).select(F.unhex(F.lpad(F.hex(F.col("id")), 40, "0")).alias("a"), "id").withColumn("b", T.table_bitmap(table))
    held = {r.id for r in other.where(T.may_hold(F.col("b"), F.col("a"))).select("id").collect()}
    assert set(range(200)) <= held and len(held) < 220
