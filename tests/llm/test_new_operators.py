"""Conversation tries, fill-in-the-middle and the rule cascade against plain Python, on edge cases, and their SQL."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import oracle
from chainfold.llm import cascade, conversation_trie as trie, fill_middle as fim
from chainfold.llm.common import QUERIES, SQL
from chainfold.llm import queries  # noqa: F401  registers all of them

FOLDER = "/root/testdata/sf0.001"
CHATS = "conv_id bigint, turn bigint, role string, text string, own bigint, shared string, block int, node string, depth int"
DOCS = "doc_id bigint, text string, n bigint, form string, pieces string, t string, h string, kept string, low bigint"


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 2, "n", 3) for r in rows], CHATS)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "f", "p", "t", "h", "k", 2) for i, t in rows], DOCS)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
@pytest.mark.parametrize("name", ["op11_conversation_trie", "op12_fill_middle", "op13_quality_cascade"])
def test_query_equals_sql(spark, name):
    ok, text = oracle.compare(spark, oracle.connect(FOLDER), name, QUERIES[name], SQL[name], FOLDER)
    assert ok, text


def plain_turns(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said[conv].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    return {conv: [t for *_, t in sorted(turns)] for conv, turns in said.items()}


def plain_rebuilt(turns):
    out = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        lender = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        out[conv] = turns.get(lender, [])[:h] + own[h:]
    return out


def plain_nodes(turns):
    members, children = defaultdict(list), defaultdict(set)
    for conv, said in turns.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(conv)
            if d:
                children[tuple(said[:d - 1])].add(tuple(said[:d]))
    out = set()
    for node, convs in members.items():
        leaves = saved = 0
        stack = [node]
        while stack:
            below = stack.pop()
            leaves += not children[below]
            saved += (len(members[below]) - 1) * (len(below[-1][1]) if below else 0)
            stack += children[below]
        ends = ",".join(map(str, sorted(c for c in convs if len(turns[c]) == len(node))))
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves, saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_trie(spark, seed):
    """Long conversations over several blocks of columns, exact copies, shared heads, ties, nulls, repeated rows."""
    draw, rows = random.Random(seed), []
    long = [("user" if i % 2 else "assistant", "x" * draw.randrange(4)) for i in range(41)]
    for conv in [-101, -100, -7, *range(0, 30), 100, 101, 102, 205]:
        said = list(long[:draw.choice([0, 1, 3, 7, 8, 9, 16, 17, 24, 40, 41])]) if draw.random() < .6 else []
        said += [(draw.choice(["user", None, "tool"]), draw.choice([None, "", "a", "bb", "ünï"])) for _ in range(draw.randrange(4))]
        rows += [(conv, draw.choice([None, 3]) if draw.random() < .1 else at, *t) for at, t in enumerate(said)]
    rows += rows[:5] + [(None, 0, "user", "lost")]
    draw.shuffle(rows)
    turns = plain_turns(rows)
    frame = chats(spark, rows).repartition(5)
    got = trie.prefix_trie(*trie.rebuilt(trie.turns_of(frame)))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    collected = [tuple(r) for r in got.collect()]
    assert len(collected) == len(set(collected)) and set(collected) == plain_nodes(plain_rebuilt(turns))


def test_trie_alone(spark):
    """Without heads from others; no table, and conversations without turns."""
    same = [(c, t, "user", f"turn {t}") for c in (5, 3, 9) for t in range(19)] + [(4, 0, "user", "turn 0")]
    turns = trie.turns_of(chats(spark, same))
    members = turns.groupBy("conv_id").count().withColumnRenamed("count", "length")
    assert {tuple(r) for r in trie.prefix_trie(turns, members).collect()} == plain_nodes(plain_turns(same))
    empty = members.selectExpr("conv_id", "0L AS length")
    assert [tuple(r)[:7] for r in trie.prefix_trie(turns.limit(0), empty).collect()] == [(3, 0, None, 4, 0, 1, 0)]
    assert trie.prefix_trie(*trie.rebuilt(trie.turns_of(chats(spark, [])))).collect() == []


TEXTS = [(1, None), (2, ""), (3, "a"), (4, "né 日本 🙂 text"), (4, "né 日本 🙂 text"), (5, "has <P> inside"), (6, "half <P and <S and M> <"),
         (None, "no id"), (7, "🙂é" * 700_000), (8, "<S>"), (9, "x" * 50)] + [(i, f"text {i} " * (i % 7 + 1)) for i in range(10, 150)]


def plain_fim(i, text):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_middle(spark):
    tables = fim.fim_tables(docs(spark, TEXTS).repartition(3)).cache()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((i, *plain_fim(i, t)[:4], sha(plain_fim(i, t)[4]), sha(t or "")) for i, t in TEXTS)
    assert Counter(tuple(r) for r in fim.digests(tables).collect()) == want
    outputs = fim.rendered(tables)
    assert Counter(tuple(r) for r in outputs.collect()) == Counter((i, plain_fim(i, t)[1], plain_fim(i, t)[4]) for i, t in TEXTS)
    assert Counter(tuple(r) for r in fim.restored(outputs).collect()) == Counter((i, t or "") for i, t in TEXTS)
    assert {r.form for r in tables.collect()} == {"plain", "psm", "spm"}
    lengths = {r.doc_id: sum(p.length for p in r.pieces if p.buffer == "text") for r in tables.collect()}
    assert all(lengths[i] == len(t or "") for i, t in TEXTS)
    assert fim.digests(fim.fim_tables(docs(spark, []))).collect() == []


def test_byte_places_over_slices(monkeypatch):
    monkeypatch.setattr(fim, "SLICE", 5)
    text = "aé日🙂" * 9
    places = fim.byte_places(text.encode(), list(range(len(text) + 1)))
    assert places == {i: len(text[:i].encode()) for i in range(len(text) + 1)}


def plain_facts(text):
    text = text or ""
    words = re.findall("[^ \t-\r]+", text)
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def quality_texts():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["日本", "É", "#", "<b>", "x|y"]
    texts = [" ".join(draw.choice(words[:draw.choice([2, 4, 35])]) for _ in range(draw.randrange(120))) for _ in range(60)]
    texts += [t.replace(" ", "\n", 9).replace(" ", "  \n\n", 3) for t in texts[:20]]
    phrase = " ".join(f"p{i}" for i in range(9))
    texts += [f"{phrase} x {phrase}", f"{phrase} {phrase} {phrase}", " ".join(["a"] * 9), " ".join(["a"] * 8), "same\nsame\n same\nsame", "x" * 90_000,
              " ".join(f"u{i}" for i in range(70_000)) + f" {phrase} y {phrase}", "A LOUD TEXT " * 9, "so! what? " * 12, None, "", " \n\t"]
    return list(enumerate(texts))


def test_cascade(spark, monkeypatch):
    rows = quality_texts() + [(3, quality_texts()[3][1]), (None, "no id at all")]
    got = cascade.judge(docs(spark, rows).repartition(3), report=cascade.BASE_FACTS).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter(
        (i, *plain_facts(t)) for i, t in rows)
    # the verdict is the one of all rules, whatever their order; a rejected document stopped at the rule that is named
    facts = {i: cascade.Facts((t or "").encode()) for i, t in rows}
    names = {r.name: r for r in cascade.RULES}
    for r in got:
        assert r.kept == (not any(rule.rejects(facts[r.doc_id]) for rule in cascade.RULES))
        assert (r.evaluated == len(names)) if r.kept else names[r.rejected_by].rejects(facts[r.doc_id])
    assert cascade.judge(docs(spark, [])).collect() == []
    monkeypatch.setattr(cascade, "SLICE", 64)       # texts over many slices
    for _, text in rows:
        sliced = cascade.Facts((text or "").encode())
        assert tuple(sliced[name] for name in cascade.BASE_FACTS) == plain_facts(text)


def test_order_by_rejections_per_cost():
    one, two, three = (lambda d: {"a": 1}), (lambda d: {"b": 1}), (lambda d: {"c": 1})
    rules = tuple(cascade.Rule(n, (f,), lambda f: True) for n, f in (("dear", "a"), ("cheap", "b"), ("idle", "c"), ("free", "b")))
    facts = {"a": one, "b": two, "c": three}
    kept, cascade.FACTS = cascade.FACTS, facts
    try:
        costs = {one: 1.0, two: 0.1, three: 0.1}
        verdicts = np.array([[1, 0, 0, 0]] * 5 + [[0, 1, 0, 0]] * 2 + [[1, 1, 0, 1]] + [[0, 0, 0, 0]] * 2, bool)
        # cheap: 3 of 10 at 0.1; then free costs nothing more but what it rejects is gone; dear: 5 at 1; idle never rejects
        order = [rules[i].name for i in cascade.ordered_rules(rules, costs, verdicts)]
        assert order[0] in ("cheap", "free") and order.index("dear") < order.index("idle")
        free = np.array([[1, 0, 0, 0]] * 9 + [[0, 0, 0, 1]], bool)
        assert [rules[i].name for i in cascade.ordered_rules(rules, costs, free)][0] == "free"
    finally:
        cascade.FACTS = kept
    assert sorted(cascade.ordered_rules(cascade.RULES, dict.fromkeys(cascade.FACTS.values(), 1.0), np.empty((0, len(cascade.RULES)), bool))) == list(
        range(len(cascade.RULES)))
