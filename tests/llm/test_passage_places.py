"""Units cut from many texts at once against one text at a time, and every place of a repeated content."""

import random

import numpy as np

from chainfold.llm import passages
from chainfold.llm.common import words_and_lines


def texts(seed):
    draw = random.Random(seed)
    made = [b"", b"\n\n", b"one two", b"A b c d e", b"a B c d e\n" * 3, b"x" * 300_000 + b" a b c d e\n" + b"y" * 300_000]
    line = " ".join(f"l{draw.randrange(50)}" for _ in range(20))
    for _ in range(60):
        parts = [" ".join(f"w{draw.randrange(300)}" for _ in range(draw.randrange(0, 70))) for _ in range(draw.randrange(1, 9))]
        if draw.random() < 0.5:
            parts += [line] * draw.randrange(1, 4)
        draw.shuffle(parts)
        made.append(draw.choice(["\n", "\r\n", " \n\n"]).join(parts).encode())
    draw.shuffle(made)
    return made


def plain(text):
    """(first word, words, content) of all units, by their definition."""
    words, lines = words_and_lines(text)
    at, found = 0, []
    while at < len(words):
        size = int((lines == lines[at]).sum())
        if size >= passages.PARAGRAPH:
            found.append((at, size))
        at += size
    if len(words) >= passages.WINDOW:
        hashed = passages.shingles(words, passages.SHINGLE)
        width = min(passages.GAP, len(hashed))
        least = {p for i in range(len(hashed) - width + 1) for p in range(i, i + width) if hashed[p] == hashed[i:i + width].min()}
        found += [(p, passages.WINDOW) for p in sorted(least) if p + passages.WINDOW <= len(words)]
    return [(first, size, tuple(words[first:first + size].tolist())) for first, size in found]


def test_units_of_many_texts_are_those_of_each():
    made = texts(3)
    cut = passages.Pieces(made)
    keys, rows = cut.banded()
    for i, text in enumerate(made):
        want = plain(text)
        mine = np.flatnonzero(cut.text == i)
        assert sorted(zip(cut.first[mine].tolist(), cut.count[mine].tolist(), strict=True)) == sorted(w[:2] for w in want)
        once = cut.once[cut.text[cut.once] == i]
        assert len(once) == len({w[2] for w in want}) == len(set(cut.content[mine].tolist()))
        alone = passages.units(text)
        own = cut.text[rows] == i
        assert sorted(keys[own].tolist()) == sorted(alone[0].tolist())
        assert len(once) + int((cut.text[cut.later] == i).sum()) == len({w[:2] for w in want})


def test_a_giant_word_keeps_the_line_of_its_own():
    words, lines = words_and_lines(b"a b\n\n" + b"x" * 400_000 + b" c\nd")
    assert lines.tolist() == [0, 0, 2, 2, 3] and len(words) == 5


def test_every_place_of_a_passage_is_reported(spark):
    draw = random.Random(8)
    rare = lambda n: " ".join(f"r{draw.randrange(10 ** 6)}" for _ in range(n))
    line = rare(24)
    rows = [(1, f"{rare(30)}\n{line}"), (2, f"{line}\n{rare(9)}\n{line.upper()}\n{rare(40)}\n{line}"), (3, f"{rare(8)}\n" * 3), (4, None)] * 2
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(got) == {1, 2} and got[1].keeps_all and got[2].removed_words == 72
    whole = {(s.first_word, s.last_word) for s in got[2].passages if s.last_word - s.first_word == 24}
    assert whole == {(0, 24), (33, 57), (97, 121)}
