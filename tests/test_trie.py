import random

import pytest
from hypothesis import given, settings, strategies as st

import world
from chainfold.functions.keccak import keccak_many
from chainfold.operators import trie as T


def rows(spark, slots, address="0xaa"):
    return spark.createDataFrame([(address, s, v) for s, v in slots.items()], "address string, slot string, value string")


def slots(count, seed=1):
    rng = random.Random(seed)
    return {f"0x{rng.getrandbits(256):064x}": f"0x{rng.getrandbits(rng.choice([1, 7, 8, 64, 256])) + 1:064x}"
            for _ in range(count)}


def test_keccak_vectors():
    # Published vectors, and lengths around the block size against one-by-one hashing.
    assert keccak_many([b"", b"abc"])[0].hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert keccak_many([b"abc"])[0].hex() == "4e03657aea45a94fc7d47ba826c8d667c0d1e6e33a64a036ec44f58fa12d6c45"
    texts = [b"x" * n for n in (0, 1, 31, 32, 134, 135, 136, 137, 271, 272, 273, 600)]
    assert keccak_many(texts) == [keccak_many([t])[0] for t in texts]
    assert len(set(keccak_many(texts))) == len(texts)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=32, max_size=32), st.binary(min_size=1, max_size=33), min_size=1, max_size=40),
       st.integers(0, 3))
def test_fold_equals_plain_build_for_any_split(content, depth):
    items = sorted((k.hex(), v) for k, v in content.items())
    want = world.keccak(world.node(items, 0))
    groups = {}
    for key, value in items:
        groups.setdefault(key[:depth], []).append((key[depth:], False, value))
    folded = T.fold(list(groups.values()))
    top = T.fold([[(prefix + n[0], n[1], n[2]) for prefix, n in zip(groups, folded)]])
    assert keccak_many(T.close_nodes(top))[0] == want


def test_shared_prefixes_and_inline_children():
    for shared in (1, 8, 31, 62, 63):
        for size in (1, 27, 28, 29, 30, 31, 32, 33):
            items = sorted(("a" * shared + f"{i:x}" + "0" * (63 - shared), bytes([9]) * size) for i in range(16))
            top = T.fold([[(k, False, v) for k, v in items]])
            assert keccak_many(T.close_nodes(top))[0] == world.keccak(world.node(items, 0))


@pytest.mark.parametrize("count", [1, 2, 17, 200])
def test_storage_roots(spark, count):
    content = slots(count)
    want = world.storage_root(content)
    for bucket in (4096, 5):
        got = T.storage_roots(rows(spark, content), bucket).collect()
        assert [(r.storage_root, r.nonzero_slots) for r in got] == [(want, count)]


def test_many_accounts_and_a_dominant_one(spark):
    accounts = {"0xbig": slots(400, 2), **{f"0x{i:040x}": slots(i % 4 + 1, i) for i in range(12)}}
    df = spark.createDataFrame([(a, s, v) for a, content in accounts.items() for s, v in content.items()],
                               "address string, slot string, value string")
    got = {r.address: r.storage_root for r in T.storage_roots(df, 16).collect()}
    assert got == {a: world.storage_root(content) for a, content in accounts.items()}


def test_bad_slots_fail(spark):
    word = "0x" + "00" * 31 + "01"
    for slot, value in ((word, "0x" + "00" * 32), ("0x01", word), (word, "0x1")):
        with pytest.raises(Exception, match="nonzero 32-byte words"):
            T.storage_roots(rows(spark, {slot: value})).collect()
    twice = rows(spark, {word: word}).unionByName(rows(spark, {word: word}))
    with pytest.raises(Exception):
        T.storage_roots(twice).collect()


def test_empty_account(spark):
    accounts = spark.createDataFrame([("0xaa",), ("0xbb",)], "address string")
    got = {r.address: (r.storage_root, r.nonzero_slots) for r in T.account_roots(accounts, rows(spark, slots(3))).collect()}
    assert got["0xbb"] == (world.EMPTY, 0) and got["0xaa"][1] == 3
