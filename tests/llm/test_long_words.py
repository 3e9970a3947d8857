"""Words longer than the lattices of equal lengths are learned from like all others."""

import numpy as np

from chainfold.llm import lattice


def test_long_words_count_pieces(monkeypatch):
    v = lattice.existing()
    some = [b"antidisestablishment" * 6, b"x" * 97, "été".encode() * 40, b"the"]
    got = lattice.expected_pieces(some, v)
    assert abs(sum(n * len(p) for n, p in zip(got, v.pieces, strict=True)) - sum(len(w) + 1 for w in some)) < 1e-6
    monkeypatch.setattr(lattice, "LONG", 1 << 20)       # all by the lattices of equal lengths
    assert np.allclose(got, lattice.expected_pieces(some, v))
