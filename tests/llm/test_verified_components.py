"""Verification of loose components: exact trees, and rows in proportion to a family of near copies."""

import random

import numpy as np
import pytest

from chainfold.llm import simhash


def loose_and_sets(spark, groups):
    """One loose component per list of sets."""
    rows, sets, node = [], [], 0
    for root, members in enumerate(groups):
        for values in members:
            rows.append((root, node))
            sets.append((node, sorted(values)))
            node += 1
    return (spark.createDataFrame(rows, "root bigint, node bigint"),
            spark.createDataFrame(sets, "node bigint, shingles array<bigint>"), rows, dict(sets))


def plain_roots(rows, sets):
    parent = {n: n for _, n in rows}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for i, (a, m) in enumerate(rows):
        for b, n in rows[:i]:
            x, y = set(sets[m]), set(sets[n])
            if a == b and len(x & y) >= 0.8 * len(x | y):
                parent[max(top(m), top(n))] = min(top(m), top(n))
    return {n: top(n) for n in parent}


def family(draw, start, count, changed=4, size=60):
    base = range(start, start + size)
    return [{v + 10 ** 6 * draw.randrange(1, 9) if i < changed else v for i, v in enumerate(draw.sample(base, size))} for _ in range(count)]


def chain(start, count, size=50, step=5):
    return [set(range(start + step * i, start + step * i + size)) for i in range(count)]


@pytest.mark.parametrize(("block", "weight"), [(8, 1 << 22), (256, 500)])
def test_trees_are_exact(spark, monkeypatch, block, weight):
    draw = random.Random(3)
    monkeypatch.setattr(simhash, "SETS", block)
    monkeypatch.setattr(simhash, "WEIGHT", weight)
    groups = [family(draw, 0, 50) + family(draw, 500, 6) + chain(2_000, 40) + [{n, n + 1} for n in range(9_000, 9_040, 4)],
              chain(0, 30), family(draw, 0, 3), [{1, 2, 3}], [set(range(9 * n, 9 * n + 9)) for n in range(25)]]
    for members in groups:
        draw.shuffle(members)
    loose, sets, rows, plain = loose_and_sets(spark, groups)
    got = {r.node: r.root for r in simhash.verified(loose, sets).collect()}
    want = plain_roots(rows, plain)
    assert {n: got.get(n, n) for n in want} == want


def test_edges_of_a_family_are_linear(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SETS", 32)
    seen, plain = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda edges, a, b: (seen.append(edges.count()), plain(edges, a, b))[1])
    most = []
    for count in (250, 1_000):
        draw = random.Random(count)
        loose, sets, rows, _ = loose_and_sets(spark, [family(draw, 0, count, changed=2) + [{n, n + 1} for n in range(9_000, 9_020)]])
        seen.clear()
        roots = {r.root for r in simhash.verified(loose, sets).collect()}
        assert len(roots) == 1
        most.append(max(seen))
    assert np.all(np.array(most) < 1.2 * np.array([250, 1_000]))


def test_empty_tables(spark):
    loose, sets, _, _ = loose_and_sets(spark, [])
    assert simhash.verified(loose, sets).count() == 0
