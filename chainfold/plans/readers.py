"""Pins, account lookups, pages under a pin, and the read audit."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.operators import digest as D, paging as G, telemetry, trie
from chainfold.operators.persistence import parse_accounts
from chainfold.plans import store
from chainfold.sources import folders


def pin(spark: SparkSession, root: str, snapshot_id: str, purpose: str = "") -> dict:
    """Protect one published checkpoint for a reader."""
    header = store.manifest(spark, root, snapshot_id)["header"]
    row = (store.new_id(), snapshot_id, store.now_ns(), purpose)
    store.write_row(spark, store.part(root, store.PINS, "pin_id", row[0]), row, store.PIN)
    return {"pin_id": row[0], "snapshot_id": snapshot_id, "created_at": row[2], "purpose": purpose, "header": header}


def pins(spark: SparkSession, root: str) -> DataFrame:
    return store.pins(spark, root)


def read_pin(spark: SparkSession, root: str, pin_id: str) -> dict:
    path = store.part(root, store.PINS, "pin_id", pin_id)
    if not folders.written(spark, path):
        raise LookupError("unknown pin")
    return spark.read.schema(store.PIN).parquet(path).first().asDict() | {"pin_id": pin_id}


def unpin(spark: SparkSession, root: str, pin_id: str) -> dict:
    record = read_pin(spark, root, pin_id)
    folders.delete(spark, store.part(root, store.PINS, "pin_id", pin_id))
    return {"pin_id": pin_id, "snapshot_id": record["snapshot_id"], "released": True}


def _address(text: str) -> str:
    found = parse_accounts(text)
    if len(found) != 1:
        raise ValueError("expected one account")
    return found[0]


def show(spark: SparkSession, root: str, snapshot_id: str, address: str) -> dict:
    """One account's metadata; an account outside the checkpoint is an error."""
    published = store.manifest(spark, root, snapshot_id)
    row = G.account_row(store.snapshot_accounts(spark, root, snapshot_id), _address(address)).first()
    if row is None:
        raise LookupError("account is not in this checkpoint")
    return {**row.asDict(), "snapshot_id": snapshot_id, "header": published["header"]}


def page(spark: SparkSession, root: str, pin_id: str, address: str, cursor: str | None = None,
         limit: int = 1000) -> dict:
    """Up to ``limit`` slots in key order and the token of the next page."""
    pinned = read_pin(spark, root, pin_id)
    snapshot_id, account = pinned["snapshot_id"], _address(address)
    metadata = show(spark, root, snapshot_id, account)
    after = G.token_slot(cursor, snapshot_id, account) if cursor else ""
    files = store.page_storage(spark, root, snapshot_id, account, after, min(limit, G.MAX_PAGE) + 1)
    rows = G.keyset_rows(files, account, after, limit).collect()
    more, rows = len(rows) > limit, rows[:limit]
    return {"pin_id": pin_id, "snapshot_id": snapshot_id, "header": metadata["header"],
            "account": {**metadata, "nonce": str(metadata["nonce"])},
            "storage": [(r["slot"], r["value"]) for r in rows],
            "next_cursor": G.page_token(snapshot_id, account, rows[-1]["slot"]) if more else None}


def audit_reads(spark: SparkSession, root: str, snapshot_id: str, address: str, passes: int = 1,
                page_size: int = 1000) -> dict:
    """Read an account page by page, several times: same content each time, declared count, proven root.

    Each page goes to the shared folder as it comes, so the driver holds one page at a time; the
    checks then run over those tables.
    """
    if not 1 <= passes <= 10:
        raise ValueError("use 1 to 10 passes")
    from chainfold.session import shared_folder
    declared = show(spark, root, snapshot_id, address)
    pinned = pin(spark, root, snapshot_id, "read audit")
    area = f"{shared_folder(spark)}/reads-{store.new_id()}"
    calls, found = [], []
    try:
        for number in range(passes):
            cursor, index = None, 0
            while True:
                began = time.perf_counter()
                answer = page(spark, root, pinned["pin_id"], address, cursor, page_size)
                calls.append((number, index, time.perf_counter() - began))
                if len(answer["storage"]) > page_size:
                    raise ValueError("reader exceeded the page size")
                rows = [(declared["address"], index, i, s, v) for i, (s, v) in enumerate(answer["storage"])]
                if rows:
                    spark.createDataFrame(rows, "address string, page int, place int, slot string, value string").write.mode(
                        "append").parquet(f"{area}/pass={number}")
                cursor, index = answer["next_cursor"], index + 1
                if cursor is None:
                    break
            if not folders.exists(spark, f"{area}/pass={number}"):
                found.append((None, 0, "empty"))
                continue
            got = spark.read.parquet(f"{area}/pass={number}")
            from chainfold.operators.continuity import require_none
            from chainfold.operators.quality import order_violations
            require_none(order_violations(got, ["address"], ["page", "place"], "slot"), "reader returned unordered slots")
            digest = D.state_digest(got).first()
            root_row = trie.storage_roots(got.select("address", "slot", "value")).first()
            if root_row["storage_root"] != declared["storage_root"]:
                raise ValueError("storage root mismatch in returned pages")
            found.append((digest["state_sha256"], digest["nonzero_slots"], root_row["storage_root"]))
    finally:
        unpin(spark, root, pinned["pin_id"])
        folders.delete(spark, area)
    if any(n != declared["nonzero_slots"] for _, n, _ in found) or len({d for d, _, _ in found}) != 1:
        raise ValueError("pinned account content is incomplete or changed between passes")
    timing = telemetry.distribution(spark.createDataFrame(calls, "pass int, page int, seconds double"), "seconds",
                                    nonnegative=True).first().asDict()
    return {"passes": passes, "calls": len(calls), "nonzero_slots": found[0][1], "state_sha256": found[0][0],
            "latency": timing}
