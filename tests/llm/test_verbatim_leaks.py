"""Verbatim leaks: runs of an item's words are found whatever stands in them, compared with a plain search."""

import random
import re

import pytest
from pyspark.sql import functions as F

from chainfold.llm import templates

DENSE = "On 12 May Anna Bell paid 40 euros, Carl Dunn paid 55 euros, Eve Ford paid 60 dollars, Guy Hall 75 and Ida 9."
SHORT = "What is 12 plus 30?"


def plain_words(text):
    return [(re.sub(r"^[^\w$%+-]+|[^\w%]+$", "", w) or w).lower() for w in (text or "").split()]


def plain_leaks(docs, items):
    found = set()
    for item, said in items:
        words = plain_words(said)
        n = min(templates.RUN, len(words))
        runs = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= templates.LEAST else set()
        found |= {(d, item) for d, t in docs for w in [plain_words(t)] if any(tuple(w[i:i + n]) in runs for i in range(len(w) - n + 1))}
    return found


@pytest.fixture(scope="module")
def case():
    draw = random.Random(4)
    prose = lambda n: " ".join(draw.choice(["river", "stone", "Anna", "7", "walks", "to", "Berlin", "12", "km", "under", "old", "trees,"]) + draw.choice(["", "", "x", "y", "z"]) for _ in range(n))
    items = [(1, DENSE), (2, SHORT), (3, prose(70)), (4, prose(12)), (5, prose(13)), (6, "only four words here"), (7, None), (8, ""), (None, prose(20))]
    texts = dict(items)
    long = texts[3].split()
    docs = [(10, DENSE), (11, f"He asked: {SHORT} Then he left."), (12, f"{prose(20)} {' '.join(long[20:55])} {prose(20)}"),
            (13, " ".join(long[5:18])), (14, " ".join(long[5:17])), (15, texts[4].upper()), (16, " ".join(texts[4].split()[:11])),
            (17, f"{prose(30)}\n{texts[5]}"), (18, "only four words here"), (19, None), (20, ""), (21, texts[None]), (21, texts[None]),
            (None, SHORT), (22, f"{DENSE} {SHORT} {texts[3]}"), (23, prose(5_000) + " " + texts[5])]
    return items, docs + [(100 + n, prose(40)) for n in range(60)]


def test_equals_a_plain_search(spark, case):
    items, docs = case
    bench = spark.createDataFrame(items, "item_id int, text string")
    rows = spark.createDataFrame(docs, "doc_id int, text string").withColumn("mark", F.lit("m")).withColumn("__gone", F.lit(2))
    got = templates.leaks(rows, bench).collect()
    want = plain_leaks(docs, items)
    assert {(10, 1), (11, 2), (12, 3), (13, 3), (15, 4), (17, 5), (None, 2), (21, None)} <= want and not want & {(14, 3), (16, 4), (18, 6)}
    verbatim = {(r.doc_id, r.item_id) for r in got if r.kind == "verbatim"}
    assert want <= {(r.doc_id, r.item_id) for r in got} and verbatim >= want - {(r.doc_id, r.item_id) for r in got if r.kind != "verbatim"}
    assert len(got) == len({(r.doc_id, r.item_id) for r in got}) + 1           # document 21 stands there twice
    assert {r.doc_id for r in got} & set(range(100, 160)) == {d for d, _ in want} & set(range(100, 160))
    stay = templates.keep_clean(rows, bench)
    assert stay.columns == rows.columns and {r.doc_id for r in stay.collect()} == {d for d, _ in docs} - {r.doc_id for r in got}


def test_run_of_a_long_item(spark, case):
    items, docs = case
    bench = spark.createDataFrame(items, "item_id int, text string")
    (row,) = [r for r in templates.leaks(spark.createDataFrame([d for d in docs if d[0] == 12], "doc_id int, text string"), bench).collect()]
    assert row.item_id == 3 and row.kind == "verbatim" and (row.first_word, row.last_word) == (20, 55) and row.matched == 23


def test_empty_tables(spark, case):
    items, docs = case
    bench, rows = spark.createDataFrame(items, "item_id int, text string"), spark.createDataFrame(docs, "doc_id int, text string")
    assert templates.leaks(rows.limit(0), bench).count() == 0 and templates.leaks(rows, bench.limit(0)).count() == 0
    assert templates.keep_clean(rows, bench.limit(0)).count() == len(docs)
