"""Event log, current-state tables and the views over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chainfold import schema as S
from chainfold.functions import scalars as X

LOGS = ["storage_changes", "balance_changes", "nonce_changes", "code_changes", "set_code_authorizations"]


def block_bucket(step: int, number: str = "number") -> Column:
    """Lower bound of the range partition a block belongs to."""
    return F.col(number) - F.col(number) % F.lit(step)


def partition_plan(frame: DataFrame, step: int, first: int, stop: int) -> DataFrame:
    """Range partitions [from, to) of every log that cover [first, stop)."""
    low = first - first % step
    starts = frame.sparkSession.range(low, stop, step).withColumnRenamed("id", "from_block")
    names = F.explode(F.array(*[F.lit(n) for n in LOGS])).alias("log")
    return starts.select(names, "from_block", (F.col("from_block") + step).alias("to_block")).withColumn(
        "partition", F.concat("log", F.lit("_p"), F.col("from_block").cast("string")))


def missing_partitions(rows: DataFrame, existing: DataFrame, step: int) -> DataFrame:
    """Buckets that hold rows but are not created yet (the default partition catches them)."""
    used = rows.select(block_bucket(step).alias("from_block")).distinct()
    return used.join(existing.select("from_block"), "from_block", "left_anti")


def event_log(persisted: DataFrame, kind: str, changes: DataFrame) -> DataFrame:
    """Long rows of one log with readable provenance."""
    shown = {
        "storage": [X.word("key").alias("slot"), X.word("old_value").alias("old_value"),
                    X.word("new_value").alias("new_value")],
        "balances": [F.col("old_value"), F.col("new_value"), F.col("reason")],
        "nonces": [F.col("old_value"), F.col("new_value")],
        "codes": [X.hex_text("old_hash").alias("old_hash"), X.hex_text("new_hash").alias("new_hash")],
    }[kind]
    tx_hash = F.when(F.length(F.coalesce("tx_hash", F.lit(b""))) == 0, F.lit("")).otherwise(X.hex_text("tx_hash"))
    return changes.select(
        F.col("number").alias("block_num"), "ordinal", X.hex_text("block_hash").alias("block_hash"),
        F.timestamp_seconds("timestamp").alias("timestamp"), X.hex_text("address").alias("address"), *shown,
        X.scope_name("scope").alias("scope"), tx_hash.alias("tx_hash"), "tx_index", "tx_status", "call_index")


def authorization_log(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("number").alias("block_num"), X.hex_text("tx_hash").alias("tx_hash"), "auth_index",
        X.hex_text("block_hash").alias("block_hash"), F.timestamp_seconds("timestamp").alias("timestamp"),
        "tx_index", "tx_status", X.hex_text("authority").alias("authority"),
        X.hex_text("delegate").alias("delegate"), "nonce", "discarded")


def block_rows(persisted: DataFrame) -> DataFrame:
    """One summary row per block, also for blocks without matching changes."""
    return persisted.select(
        F.col("number").alias("block_num"), X.hex_text("hash").alias("block_hash"),
        X.hex_text("parent_hash").alias("parent_hash"), F.timestamp_seconds("timestamp").alias("timestamp"),
        X.hex_text("state_root").alias("state_root"), X.hex_text("coinbase").alias("coinbase"),
        "transaction_count", F.size("storage").alias("storage_changes"),
        F.size("balances").alias("balance_changes"), F.size("nonces").alias("nonce_changes"),
        F.size("codes").alias("code_changes"))


def summarize_blocks(blocks: DataFrame, changes: DataFrame, kinds: list[str]) -> DataFrame:
    """Summary from flat tables: blocks(number, …) and changes(number, kind); empty blocks give zeros."""
    counts = changes.groupBy("number").agg(*[
        F.count(F.when(F.col("kind") == kind, 1)).alias(f"{kind}_changes") for kind in kinds])
    return blocks.join(counts, "number", "left").select(
        *blocks.columns, *[F.coalesce(f"{kind}_changes", F.lit(0)).alias(f"{kind}_changes") for kind in kinds])


def deduplicated_log(rows: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """One row per key. With a version the newest wins; otherwise equal retries collapse to one,
    chosen by value so that every run keeps the same row."""
    rest = [c for c in rows.columns if c not in keys]
    order = ([version] if version else []) + [c for c in rest if c != version]
    best = F.max(F.struct(*order)).alias("best")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"best.{c}").alias(c) for c in rest])


# ---------------------------------------------------------------- current state

def current_storage(changes: DataFrame) -> DataFrame:
    """Newest value per slot from event-log rows; zero values stay as rows.

    A later row wins on equal ordinals, so source order is part of the position when present.
    """
    place = [F.col("place")] if "place" in changes.columns else []
    best = F.max(F.struct(F.col("number").alias("block_num"), "ordinal", *place, "value")).alias("b")
    return changes.groupBy("address", "slot").agg(best).select(
        "address", "slot", "b.value", "b.block_num", "b.ordinal")


def current_accounts(balances: DataFrame, nonces: DataFrame, codes: DataFrame) -> DataFrame:
    """Newest balance, nonce and code hash, each with the block that set it."""
    at = ["number", "ordinal", "address"]
    rows = (balances.select(*at, F.col("new_value").alias("balance"))
            .unionByName(nonces.select(*at, F.col("new_value").cast(S.UINT64).alias("nonce")), allowMissingColumns=True)
            .unionByName(codes.select(*at, F.col("new_hash").alias("code_hash")), allowMissingColumns=True))
    names = ["balance", "nonce", "code_hash"]
    best = [F.max(F.when(F.col(n).isNotNull(), F.struct("number", "ordinal", n))).alias(f"_{n}") for n in names]
    short = {"balance": "balance", "nonce": "nonce", "code_hash": "code"}
    return rows.groupBy("address").agg(*best).select(
        "address", *[F.col(f"_{n}.{n}").alias(n) for n in names],
        F.greatest(*[F.col(f"_{n}.number") for n in names]).alias("block_num"),
        *[F.col(f"_{n}.number").alias(f"{short[n]}_block_num") for n in names])


def merge_storage(old: DataFrame, new: DataFrame) -> DataFrame:
    """Fold a batch into the stored state by chain position: order of arrival does not matter."""
    return newest_storage(old.unionByName(new))


def newest_storage(rows: DataFrame) -> DataFrame:
    best = F.max(F.struct("block_num", "ordinal", "value")).alias("b")
    return rows.groupBy("address", "slot").agg(best).select("address", "slot", "b.value", "b.block_num", "b.ordinal")


def merge_accounts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Field-wise merge: a batch that only knows a balance leaves nonce and code alone."""
    return newest_accounts(old.unionByName(new))


def newest_accounts(rows: DataFrame) -> DataFrame:
    pairs = {"balance": "balance_block_num", "nonce": "nonce_block_num", "code_hash": "code_block_num"}
    best = [F.max(F.when(F.col(n).isNotNull(), F.struct(b, n))).alias(f"_{n}") for n, b in pairs.items()]
    merged = rows.groupBy("address").agg(F.max("block_num").alias("block_num"), *best)
    return merged.select("address", *[F.col(f"_{n}.{n}").alias(n) for n in pairs], "block_num",
                         *[F.col(f"_{n}.{b}").alias(b) for n, b in pairs.items()])


def distinct_code(codes: DataFrame) -> DataFrame:
    """Byte-code once per hash, with the first block that showed it. Empty code is left out."""
    return (codes.where(F.length("new_code") > 0).groupBy(F.col("new_hash").alias("code_hash"))
            .agg(F.min("new_code").alias("code"), F.min("number").alias("first_block_num"))
            .select("code_hash", "code", F.length("code").alias("size"), "first_block_num"))


# ---------------------------------------------------------------- views

def storage_nonzero(storage: DataFrame) -> DataFrame:
    return storage.where(F.col("value") != X.ZERO_WORD)


def account_state(accounts: DataFrame, code: DataFrame) -> DataFrame:
    """Accounts with their byte-code; an unknown hash leaves the code NULL."""
    known = code.select("code_hash", F.concat(F.lit("0x"), F.lower(F.hex("code"))).alias("code"),
                        F.col("size").alias("code_size"))
    return accounts.join(known, "code_hash", "left")


def head(blocks: DataFrame) -> DataFrame:
    return blocks.orderBy(F.desc("block_num")).limit(1)


def last_touch(accounts: DataFrame) -> DataFrame:
    """Last block that touched any field; NULL fields do not count."""
    names = [n for n in ("block_num", "balance_block_num", "nonce_block_num", "code_block_num", "first_block_num")
             if n in accounts.columns]
    return accounts.withColumn("last_block", F.greatest(*names))
