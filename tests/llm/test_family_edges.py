"""A large family of near copies costs a few edges a member, however many tables find it."""

import random

from chainfold.llm import simhash
from chainfold.llm.components import components


def test_a_family_gives_few_edges(spark):
    draw = random.Random(5)
    base = draw.getrandbits(256)
    prints = list({base ^ sum(1 << b for b in draw.sample(range(256), 24)) for _ in range(300)} | {draw.getrandbits(256) for _ in range(50)})
    rows = spark.createDataFrame([(n, bytearray(p.to_bytes(32, "big"))) for n, p in enumerate(prints)], "id bigint, p binary").cache()
    edges = simhash.near_edges(rows, 4, 57, 0.97).cache()
    assert edges.count() <= 300 * (simhash.FIRST + 1)
    roots = {r.node: r.root for r in components(edges, "a", "b").collect()}
    family = [n for n, p in enumerate(prints) if (p ^ base).bit_count() == 24]
    assert {roots[n] for n in family} == {min(family)} and len(roots) == len(family)
