"""Block-end values and lifecycle effects, and the one-row-per-block envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chainfold import schema as S
from chainfold.functions import scalars as X
from chainfold.operators import persistence as P
from chainfold.operators.account_table import table_name
from chainfold.session import cut

# Fixed value: from this block time on, only accounts created in the same transaction vanish.
DELETION_FORK_TIME = 1_718_863_500


# ---------------------------------------------------------------- reductions

def last_per_block(changes: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Last value per (block, key) by ordinal; equal ordinals fall back to source order.

    ``max`` of one struct combines on the map side, so a busy key never reaches one task whole.
    """
    order = ["ordinal"] + (["place"] if "place" in changes.columns else [])
    best = F.max(F.struct(*order, *values)).alias("best")
    return changes.groupBy("number", *keys).agg(best).select(
        "number", *keys, *[F.col(f"best.{name}").alias(name) for name in values],
        F.col("best.ordinal").alias("ordinal"))


def nonce_resets(nonces: DataFrame) -> DataFrame:
    return nonces.where("new_value < old_value").select(
        "number", "address", F.lit("nonce_reset").alias("kind"), "ordinal")


def code_clears(codes: DataFrame) -> DataFrame:
    return codes.where(F.length("new_code") == 0).select(
        "number", "address", F.lit("code_cleared").alias("kind"), "ordinal")


def code_identity(new_hash: Column, new_code: Column) -> Column:
    """Code hash text. An absent hash is allowed only for absent code."""
    size = F.length(F.coalesce(new_hash, F.lit(b"")))
    empty = (size == 0) & (F.length(F.coalesce(new_code, F.lit(b""))) == 0)
    return F.when(size == 32, X.hex_text(new_hash)).when(empty, F.lit(X.EMPTY_CODE_HASH)).otherwise(
        F.raise_error(F.lit("invalid code hash")).cast("string"))


# ---------------------------------------------------------------- call ancestry

def execution_address(call: Column, calls: Column) -> Column:
    """Account a call runs as: climb to the parent while the call is delegated.

    The climb is bounded by the call list itself; a chain that does not end is an error.
    """
    delegated = lambda c: F.coalesce(c["call_type"].isin(P.CALLCODE, P.DELEGATE), F.lit(False))
    fields = ["index", "parent_index", "call_type", "address"]
    slim = lambda c: F.struct(*[c[name].alias(name) for name in fields])
    parent = lambda c: F.get(F.filter(
        F.transform(calls, slim), lambda p: (p["index"] == c["parent_index"]) & (p["index"] != c["index"])), 0)
    end = F.aggregate(calls, slim(call), lambda c, _: F.when(delegated(c), parent(c)).otherwise(c))
    return F.when(end.isNotNull() & ~delegated(end), end["address"]).otherwise(F.raise_error(F.lit(
        "delegated call without an execution context")).cast("binary"))


def execution_accounts(calls: DataFrame, tx: str = "tx") -> DataFrame:
    """The same climb for a flat table of calls(tx, index, parent_index, delegated, address).

    Every unresolved call points at its parent and each round doubles the distance it looks up, so a
    chain of any length ends after log2(length) joins on (tx, index). A call whose chain leaves the
    table or runs in a circle keeps a NULL account.
    """
    up = F.when(~F.col("delegated"), F.col("index")).when(
        F.col("parent_index") != F.col("index"), F.col("parent_index"))
    state = cut(calls.select(tx, "index", "address", "delegated", up.alias("at")))
    longest, distance = state.count(), 1          # no chain is longer than the table
    while distance <= longest:
        target = state.select(tx, F.col("index").alias("at"), F.col("at").alias("next"),
                              F.col("delegated").alias("open"))
        moved = cut(state.join(target, [tx, "at"], "left"))
        if moved.where("delegated AND open AND next IS NOT NULL").isEmpty():
            break
        state = moved.select(tx, "index", "address", "delegated",
                             F.when(F.col("open"), F.col("next")).otherwise(F.col("at")).alias("at"))
        distance *= 2
    ends = state.where("NOT delegated").select(tx, F.col("index").alias("at"), F.col("address").alias("account"))
    return state.join(ends, [tx, "at"], "left").select(tx, "index", "account")


def destroying_calls(blocks: DataFrame) -> DataFrame:
    """Committed destroying calls with their account, transaction end and creation flag."""
    live = lambda c: ~F.coalesce(c["state_reverted"], F.lit(False))
    destroys = lambda c: F.coalesce(c["suicide"], F.lit(False)) & live(c)
    seconds = F.coalesce(F.col("header.timestamp.seconds"), F.lit(0))
    system = F.exists(F.coalesce(F.col("system_calls"), F.array()), destroys)
    guarded = F.when(system, F.raise_error(F.lit("destroying call in system execution")).cast("boolean"))
    traces = F.filter("transaction_traces", lambda t: (t["status"] == P.SUCCEEDED)
                      & F.exists(F.coalesce(t["calls"], F.array()), destroys))
    calls = F.col("tx.calls")
    created = F.transform(F.filter(calls, lambda c: live(c) & (c["call_type"] == P.CREATE)), lambda c: c["address"])
    rows = F.transform(F.filter(calls, destroys), lambda c: F.struct(
        execution_address(c, calls).alias("account"), c["end_ordinal"].alias("call_end"),
        F.coalesce(F.col("tx.end_ordinal"), F.lit(0)).alias("tx_end")))
    return (blocks.where(F.coalesce(guarded, F.lit(True)))
            .select("number", seconds.alias("timestamp"), traces.alias("traces"))
            .select("number", "timestamp", F.explode("traces").alias("tx"))
            .select("number", "timestamp", created.alias("created"), rows.alias("rows"))
            .select("number", "timestamp", "created", F.explode("rows").alias("d"))
            .select("number", "timestamp", X.hex_text("d.account").alias("address"), "d.call_end", "d.tx_end",
                    F.array_contains("created", F.col("d.account")).alias("created_here")))


def selfdestructs(destroying: DataFrame) -> DataFrame:
    return destroying.select("number", "address", F.lit("selfdestruct").alias("kind"),
                             F.col("call_end").alias("ordinal"))


def deletions(destroying: DataFrame, fork_time: int = DELETION_FORK_TIME) -> DataFrame:
    """Accounts removed at transaction end, at the latest such end within the block."""
    vanishes = (F.col("timestamp") < fork_time) | F.col("created_here")
    unreliable = (F.col("tx_end") == 0) | (F.col("tx_end") <= F.col("call_end"))
    end = F.when(unreliable, F.raise_error(F.lit("deletion has no reliable transaction end")).cast("bigint")
                 ).otherwise(F.col("tx_end"))
    return (destroying.where(vanishes).select("number", "address", end.alias("ordinal"))
            .groupBy("number", "address").agg(F.max("ordinal").alias("ordinal")))


def surviving_storage(storage: DataFrame, removed: DataFrame) -> DataFrame:
    """Drop storage written at or before the account's deletion in the same block."""
    cut = removed.select("number", "address", F.col("ordinal").alias("removed_at"))
    return (storage.join(cut, ["number", "address"], "left")
            .where("removed_at IS NULL OR ordinal > removed_at").drop("removed_at"))


def with_deletion_defaults(values: DataFrame, removed: DataFrame, **defaults: Column) -> DataFrame:
    """Reset a field at the deletion unless the block writes it at or after that point."""
    names = list(defaults)
    blank = removed.select("number", "address", *[c.alias(n) for n, c in defaults.items()], "ordinal",
                           F.lit(0).alias("given"))
    both = values.select("number", "address", *names, "ordinal", F.lit(1).alias("given")).unionByName(blank)
    best = F.max(F.struct("ordinal", "given", *names)).alias("best")
    return both.groupBy("number", "address").agg(best).select(
        "number", "address", *[F.col(f"best.{n}").alias(n) for n in names], F.col("best.ordinal").alias("ordinal"))


# ---------------------------------------------------------------- envelopes

def assemble(blocks: DataFrame, storage: DataFrame, balances: DataFrame, nonces: DataFrame,
             codes: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """Join the kinds back to one row per block in a single shuffle on the block number.

    A block's arrays are bounded by the block itself, which is one row in this data model.
    """
    parts = {"storage": storage, "balances": balances, "nonces": nonces, "codes": codes, "lifecycle": lifecycle}
    head = [name for name in blocks.columns if name != "number"]
    rows = blocks.select("number", F.struct(*head).alias("head"))
    for name, frame in parts.items():
        fields = [f.name for f in S.GROUPS[name].fields]
        rows = rows.unionByName(
            frame.select("number", F.struct(*fields).cast(S.GROUPS[name]).alias(name)), allowMissingColumns=True)
    keyed = {
        "lifecycle": lambda c: F.struct(c["address"], c["ordinal"], c["kind"]),
    }

    def ordered(name: str) -> Column:
        items = F.collect_list(name)
        if name not in keyed:            # struct order is already (address[, slot], ...)
            return F.array_sort(items).alias(name)
        moved = F.array_sort(F.transform(items, lambda c: F.struct(
            c["address"].alias("address"), c["ordinal"].alias("ordinal"), c["kind"].alias("kind"))))
        return F.transform(moved, lambda c: F.struct(
            c["address"].alias("address"), c["kind"].alias("kind"), c["ordinal"].alias("ordinal"))).alias(name)

    grouped = rows.groupBy("number").agg(F.first("head", ignorenulls=True).alias("head"),
                                         *[ordered(name) for name in parts])
    return grouped.where("head IS NOT NULL").select("number", "head.*", *parts)


def block_state(blocks: DataFrame, accounts: str | DataFrame, fork_time: int = DELETION_FORK_TIME) -> DataFrame:
    """Envelopes of the selected accounts: one row per block, empty blocks included.

    ``accounts`` is a list as text, which every envelope repeats, or a table with ``address``, of which it names size and hash.
    """
    whole = isinstance(accounts, DataFrame)
    chosen = [] if whole else P.parse_accounts(accounts)
    if not whole and not chosen:
        raise ValueError("block_state needs an explicit account list")
    source = P.admitted(blocks)
    changes = P.granular_changes(source, accounts)
    named = {kind: changes[kind].withColumn("address", X.hex_text("address"))
             for kind in ("storage", "balances", "nonces", "codes")}
    destroying = destroying_calls(source)
    destroying = P.of_accounts(destroying, accounts) if whole else destroying.where(F.col("address").isin(chosen))
    removed = deletions(destroying, fork_time)
    storage = last_per_block(
        named["storage"].withColumn("slot", X.word("key")).withColumn("value", X.word("new_value")),
        ["address", "slot"], ["value"])
    balances = last_per_block(named["balances"].withColumnRenamed("new_value", "value"), ["address"], ["value"])
    nonces = last_per_block(named["nonces"].withColumnRenamed("new_value", "value").drop("old_value"),
                            ["address"], ["value"])
    codes = last_per_block(
        named["codes"].withColumn("hash", code_identity(F.col("new_hash"), F.col("new_code")))
        .withColumn("code", X.hex_text("new_code")), ["address"], ["hash", "code"])
    effects = (nonce_resets(named["nonces"]).unionByName(code_clears(named["codes"]))
               .unionByName(selfdestructs(destroying))
               .unionByName(removed.select("number", "address", F.lit("storage_reset").alias("kind"), "ordinal"))
               .distinct())
    head = source.select(
        "number", X.hex_text("hash").alias("hash"), X.hex_text("header.parent_hash").alias("parent_hash"),
        F.col("header.timestamp.seconds").alias("timestamp"), X.hex_text("header.state_root").alias("state_root"),
        F.col("ver").alias("producer_version"), (table_name(accounts) if whole else F.lit(",".join(chosen))).alias("accounts"),
        F.lit(1).alias("schema_version"))
    return assemble(
        head, surviving_storage(storage, removed),
        with_deletion_defaults(balances, removed, value=F.lit("0")),
        with_deletion_defaults(nonces, removed, value=F.lit(0).cast(S.UINT64)),
        with_deletion_defaults(codes, removed, hash=F.lit(X.EMPTY_CODE_HASH), code=F.lit("0x")), effects)
