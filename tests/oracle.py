"""Compare registered queries with their SQL on DuckDB: python tests/oracle.py [sf] [name ...]."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if hasattr(value, "as_tuple"):
        return str(int(value)) if value == int(value) else repr(float(value))
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr), [columns[i] for i in order]


def compare(spark, connection, name, function, sql, folder):
    start = time.time()
    frame = function(spark, folder)
    got = frame.collect()
    spent = time.time() - start
    left, names = rows_of(frame.columns, got)
    if sql is None:
        return True, f"{name}: {len(left)} rows, no SQL ({spent:.1f}s)"
    result = connection.sql(sql)
    right, other = rows_of(result.columns, result.fetchall())
    if names != other:
        return False, f"{name}: columns {names} against {other}"
    if left != right:
        a, b = [r for r in left if r not in set(right)][:2], [r for r in right if r not in set(left)][:2]
        return False, f"{name}: {len(left)} against {len(right)} rows; only spark {a}; only sql {b}"
    return True, f"{name}: {len(left)} rows equal ({spent:.1f}s)"


def connect(folder):
    import duckdb
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


if __name__ == "__main__":
    from chainfold.queries import collection
    from chainfold.session import local_session
    scale, wanted = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{scale}"
    session, db = local_session("oracle"), connect(folder)
    bad = 0
    for key, query in collection.QUERIES.items():
        if wanted and key not in wanted:
            continue
        try:
            ok, text = compare(session, db, key, query, collection.SQL.get(key), folder)
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, text = False, f"{key}: {type(error).__name__} {str(error)[:600]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + text, flush=True)
    print("failures:", bad)
