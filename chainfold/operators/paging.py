"""Keyset pages over one account, page chunking over all accounts, and page tokens."""

from __future__ import annotations

import base64
import json

from pyspark.sql import DataFrame, Window, functions as F

from chainfold.functions import scalars as X
from chainfold.operators.ordered import row_rank

MAX_PAGE = 10_000
MAX_TOKEN = 1_024


def keyset_rows(storage: DataFrame, address: str, after: str, limit: int) -> DataFrame:
    """At most limit+1 slots behind ``after``. The filter reaches the scan and the order becomes a
    take-ordered, so a page reads little whatever the account's size."""
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit {limit} is not in 1..10000")
    return (storage.where((F.col("address") == address) & (F.col("slot") > after))
            .orderBy("slot").limit(limit + 1).select("slot", "value"))


def page_token(snapshot_id: str, address: str, slot: str) -> str:
    text = json.dumps({"version": 1, "snapshot_id": snapshot_id, "address": address, "after_slot": slot},
                      sort_keys=True, separators=(",", ":"))
    return base64.urlsafe_b64encode(text.encode()).decode()


def token_slot(token: str, snapshot_id: str, address: str) -> str:
    if len(token) > MAX_TOKEN:
        raise ValueError("oversized page token")
    try:
        value = json.loads(base64.urlsafe_b64decode(token.encode()))
    except ValueError:
        raise ValueError("invalid page token") from None
    if (value.get("version"), value.get("snapshot_id"), value.get("address")) != (1, snapshot_id, address):
        raise ValueError("page token belongs to another checkpoint or account")
    slot = value.get("after_slot")
    if not (isinstance(slot, str) and len(slot) == 66 and slot.startswith("0x")
            and all(c in "0123456789abcdef" for c in slot[2:])):
        raise ValueError("invalid page token")
    return slot


def token_column(snapshot_id, address, slot):
    """The same token as a column."""
    body = F.concat(F.lit('{"address":"'), address, F.lit('","after_slot":"'), slot,
                    F.lit('","snapshot_id":"'), snapshot_id, F.lit('","version":1}'))
    return X.url_token(body)


def numbered_pages(storage: DataFrame, page_size: int) -> DataFrame:
    """Slots with their page number within the account; pages never mix accounts."""
    if not 1 <= page_size <= MAX_PAGE:
        raise ValueError("page size must be between 1 and 10000")
    ranked = row_rank(storage.select("address", "slot", "value"), ["address"], ["slot"])
    return ranked.withColumn("page", F.floor((F.col("rank") - 1) / page_size)).drop("rank")


def positioned(stored: DataFrame) -> DataFrame:
    """Rows of files that were written in (address, slot) order, with their ``position`` over all files, from 0.

    Parquet tells each row's place in its file, so only the number of rows before each file is missing: one row per
    file is ordered and joined, and no row is sorted, shuffled or copied. Files whose ranges overlap are an error.
    """
    rows = stored.select("address", "slot", "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    key = F.struct("address", "slot")
    files = rows.groupBy("_file").agg(F.count("*").alias("_rows"), F.min(key).alias("_first"), F.max(key).alias("_last"))
    order = Window.orderBy("_first")                       # one row per file
    overlap = F.lag("_last").over(order) >= F.col("_first")
    before = F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    offsets = files.select(F.col("_file").alias("_of"), F.when(F.coalesce(overlap, F.lit(False)), F.raise_error(
        F.concat(F.lit("rows of two files overlap at "), F.col("_file"))).cast("bigint")).otherwise(F.coalesce(before, F.lit(0))).alias("_offset"))
    return rows.join(offsets, F.col("_file") == F.col("_of")).select(
        "address", "slot", "value", (F.col("_offset") + F.col("_index")).alias("position"))


def stored_pages(stored: DataFrame, page_size: int) -> DataFrame:
    """``numbered_pages`` of files in (address, slot) order: the page follows from the position within the account.

    Where each account begins is one row per account; AQE broadcasts it if it is small and splits a busy account if not.
    """
    if not 1 <= page_size <= MAX_PAGE:
        raise ValueError("page size must be between 1 and 10000")
    rows = positioned(stored)
    begin = rows.groupBy(F.col("address").alias("_account")).agg(F.min("position").alias("_begin"))
    return rows.join(begin, F.col("address") == F.col("_account")).select(
        "address", "slot", "value", F.floor((F.col("position") - F.col("_begin")) / page_size).alias("page"))


def page_facts(pages: DataFrame) -> DataFrame:
    """Row count and borders of each page."""
    return pages.groupBy("address", "page").agg(
        F.count("*").alias("rows"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))


def coverage_defects(pages: DataFrame, accounts: DataFrame, page_size: int | None = None) -> DataFrame:
    """Page facts against accounts(address, nonzero_slots): unknown account, hole in the numbering,
    short inner page, overlap with the next page, wrong total.

    Numbering is checked by counting and by each page announcing its successor, so no account is
    gathered in one task.
    """
    per = pages.groupBy("address").agg(F.count("*").alias("n"), F.max("page").alias("top"),
                                       F.sum("rows").alias("slots"), F.countDistinct("page").alias("distinct"))
    known = accounts.select("address", F.col("nonzero_slots").alias("declared"), F.lit(True).alias("known"))
    whole = per.join(known, "address", "full").select("address", F.explode(F.filter(F.array(
        F.when(F.col("known").isNull(), F.lit("unknown account")),
        F.when(F.col("n").isNotNull() & ((F.col("top") + 1 != F.col("n")) | (F.col("distinct") != F.col("n"))),
               F.lit("page sequence")),
        F.when(F.col("known") & (F.coalesce("slots", F.lit(0)) != F.col("declared")), F.lit("slot count"))),
        lambda r: r.isNotNull())).alias("reason"))
    own = pages.select("address", "page", "first_slot", "rows", F.lit(None).cast("string").alias("before"),
                       F.lit(None).cast("bigint").alias("before_rows"))
    after = pages.select("address", (F.col("page") + 1).alias("page"), F.lit(None).cast("string").alias("first_slot"),
                         F.lit(None).cast("bigint").alias("rows"), F.col("last_slot").alias("before"),
                         F.col("rows").alias("before_rows"))
    both = own.unionByName(after).groupBy("address", "page").agg(
        F.min("first_slot").alias("first_slot"), F.max("before").alias("before"),
        F.max("before_rows").alias("before_rows"))
    inner = F.col("first_slot").isNotNull() & F.col("before").isNotNull()
    reasons = [F.when(inner & (F.col("first_slot") <= F.col("before")), F.lit("unordered pages"))]
    if page_size:
        reasons.append(F.when(inner & (F.col("before_rows") != page_size), F.lit("short inner page")))
    links = both.select("address", F.explode(F.filter(F.array(*reasons), lambda r: r.isNotNull())).alias("reason"))
    return whole.unionByName(links).distinct()


def account_row(accounts: DataFrame, address: str) -> DataFrame:
    return accounts.where(F.col("address") == address)


def sample_slots(storage: DataFrame, limit: int) -> DataFrame:
    """Bounded sample in key order (the feature itself is the bound)."""
    if limit <= 0:
        raise ValueError("sample limit must be positive")
    return storage.orderBy("address", "slot").limit(limit)
