"""The pieces of a snapshot, in order, are one JSON document with every account and slot."""

import json

from chainfold.operators import quality as Q


def test_pieces_make_the_document(spark):
    head = spark.createDataFrame([(7,)], "number bigint")
    accounts = [(f"a{i:03d}", i) for i in range(40)]
    slots = [(f"a{i:03d}", f"s{j}", f"v{i}{j}") for i in range(40) for j in range(3)]
    rows = Q.snapshot_json(head, spark.createDataFrame(accounts[::-1], "address string, n bigint").repartition(3),
                           spark.createDataFrame(slots[::-1], "address string, slot string, value string").repartition(5)).collect()
    text = "".join(r.text for r in sorted(rows, key=lambda r: (r.part, r.place)))
    assert json.loads(text) == {"header": {"number": 7}, "accounts": [{"address": a, "n": n} for a, n in accounts],
                                "storage": [{"address": a, "slot": s, "value": v} for a, s, v in slots]}


def test_an_empty_state_is_a_document(spark):
    none = spark.createDataFrame([], "address string, slot string, value string")
    rows = Q.snapshot_json(spark.createDataFrame([(7,)], "number bigint"), none.select("address"), none).collect()
    text = "".join(r.text for r in sorted(rows, key=lambda r: (r.part, r.place)))
    assert json.loads(text) == {"header": {"number": 7}, "accounts": [], "storage": []}
