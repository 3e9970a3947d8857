"""Rule tables and comparisons. A clean table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chainfold.functions import scalars as X
from chainfold.operators.ordered import previous_row, row_rank


def violations(rows: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule; NULL counts as broken."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]),
                      lambda name: name.isNotNull())
    return rows.select(*keys, broken.alias("_r")).select(*keys, F.explode("_r").alias("rule"))


def snapshot_rules(head: dict) -> dict[str, Column]:
    return {
        "required fields": F.col("nonce").isNotNull() & F.col("balance").isNotNull()
        & F.col("code_hash").isNotNull() & F.col("code").isNotNull(),
        "exact nonce": X.is_exact_uint64("nonce"),
        "code hash": X.is_fixed_hex("code_hash", 32),
        "code": X.is_hex_bytes("code"),
        "address": X.is_fixed_hex("address", 20),
        "provenance": F.col("last_block") <= head["number"],
    }


def snapshot_violations(head: dict, accounts: DataFrame, storage: DataFrame,
                        requested_block: int | None = None) -> DataFrame:
    """All rules a current-state snapshot must satisfy: (kind, address, slot, rule)."""
    if requested_block is not None and requested_block != head["number"]:
        raise ValueError("current tables only hold their head block")
    none = F.lit(None).cast("string")
    wrong = violations(accounts, ["address"], snapshot_rules(head)).select(
        F.lit("account").alias("kind"), "address", none.alias("slot"), "rule")
    twice = accounts.groupBy(F.lower("address").alias("address")).count().where("count > 1").select(
        F.lit("account").alias("kind"), "address", none.alias("slot"), F.lit("duplicate").alias("rule"))
    slot_rules = {"slot": X.is_fixed_hex("slot", 32), "value": X.is_fixed_hex("value", 32),
                  "provenance": F.col("last_block") <= head["number"]}
    slots = violations(storage, ["address", "slot"], slot_rules).select(
        F.lit("storage").alias("kind"), "address", "slot", "rule")
    again = duplicate_keys(storage.select(F.lower("address").alias("address"), F.lower("slot").alias("slot")),
                           ["address", "slot"]).select(
        F.lit("storage").alias("kind"), "address", "slot", F.lit("duplicate").alias("rule"))
    orphans = storage.select(F.lower("address").alias("address")).distinct().join(
        accounts.select(F.lower("address").alias("address")), "address", "left_anti").select(
        F.lit("storage").alias("kind"), "address", none.alias("slot"), F.lit("unknown account").alias("rule"))
    return wrong.unionByName(twice).unionByName(slots).unionByName(again).unionByName(orphans)


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def order_violations(rows: DataFrame, group: list[str], order: list[str], key: str) -> DataFrame:
    """Rows whose key does not rise strictly along the given order."""
    seen = previous_row(rows, group, order, [key])
    return seen.where(F.col(f"previous.{key}").isNotNull() & (F.col(key) <= F.col(f"previous.{key}"))).drop("previous")


def field_differences(observed: DataFrame, expected: DataFrame, fields: list[str]) -> DataFrame:
    """Observed (non-NULL) fields that differ from the expected value."""
    def long(rows: DataFrame, name: str) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(name))
                                    for f in fields])).alias("pair")
        return rows.select("address", pairs).select("address", "pair.*")
    seen = long(observed, "observed").where("observed IS NOT NULL")
    joined = seen.join(long(expected, "expected"), ["address", "field"], "left")
    return joined.where(~F.col("observed").eqNullSafe(F.col("expected")))


def state_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per slot: only on one side, or with different values. One shuffle, no join."""
    rows = (left.select("address", "slot", F.col("value").alias("left_value"),
                        F.lit(None).cast("string").alias("right_value"))
            .unionByName(right.select("address", "slot", F.lit(None).cast("string").alias("left_value"),
                                      F.col("value").alias("right_value"))))
    sides = rows.groupBy("address", "slot").agg(F.max("left_value").alias("left_value"),
                                                F.max("right_value").alias("right_value"))
    kind = F.when(F.col("right_value").isNull(), "only_left").when(
        F.col("left_value").isNull(), "only_right").otherwise("different")
    return sides.where(~F.col("left_value").eqNullSafe(F.col("right_value"))).withColumn("difference", kind)


def multiset_differences(observed: DataFrame, expected: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose number of copies differs, with the signed surplus of the observed side."""
    rows = observed.select(*columns, F.lit(1).alias("n")).unionByName(
        expected.select(*columns, F.lit(-1).alias("n")))
    return rows.groupBy(*columns).agg(F.sum("n").alias("surplus")).where("surplus <> 0")


def unexpected_changes(envelopes: DataFrame, quiet: DataFrame, groups: list[str]) -> DataFrame:
    """Patches of the named groups that touch accounts which must not change: (number, group, address)."""
    def owners(group: str) -> Column:
        return F.transform(group, lambda c: F.struct(F.lit(group).alias("group"), c["address"].alias("address")))

    touched = F.array_distinct(F.concat(*[owners(group) for group in groups])).alias("touched")
    rows = envelopes.select("number", touched).select(
        "number", F.inline("touched"))
    return rows.join(quiet.select("address").distinct(), "address", "left_semi").distinct()


def side_claims(states: DataFrame, fields: list[str]) -> DataFrame:
    """Declared before/after states(address, field, must) against (address, before, after) values.

    ``must`` is ``equal`` or ``different``.
    """
    differs = ~F.col("before").eqNullSafe(F.col("after"))
    wrong = F.when(F.col("must") == "equal", differs).otherwise(~differs)
    return states.where(F.col("field").isin(fields) & wrong)


def snapshot_json(head: DataFrame, accounts: DataFrame, storage: DataFrame) -> DataFrame:
    """Head, accounts and slots as one JSON document in pieces (part, place, text).

    The texts, put together in the order of (part, place), are the document: accounts by address, slots by address and
    slot. Places come from ranges of the keys, so no account, let alone the state, is put together in one task or value.
    """
    def body(rows: DataFrame, order: list[str]):
        return F.to_json(F.struct(*order, *[c for c in rows.columns if c not in order]), {"ignoreNullFields": "false"})

    def listed(rows: DataFrame, order: list[str], part: int) -> DataFrame:
        return rows.select(F.lit(part).alias("part"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)],
                           *[F.lit("").alias(f"_k{i}") for i in range(len(order), 2)], body(rows, order).alias("body"))

    rows = listed(accounts, ["address"], 1).unionByName(listed(storage, ["address", "slot"], 3))
    placed = row_rank(rows, ["part"], ["_k0", "_k1"], "place")
    pieces = placed.select("part", "place", F.concat(F.when(F.col("place") > 1, ",").otherwise(""), "body").alias("text"))
    one = F.lit(1).cast("bigint").alias("place")
    opening = head.select(F.lit(0).alias("part"), one, F.concat(F.lit('{"header":'), body(head, []), F.lit(',"accounts":[')).alias("text"))
    rest = head.sparkSession.createDataFrame([(2, 1, '],"storage":['), (4, 1, "]}")], "part int, place bigint, text string")
    return opening.unionByName(pieces).unionByName(rest)


def sample_verdict(sample: DataFrame, reference: DataFrame) -> DataFrame:
    """Compare sampled slots with a second source: sample parity only, never a proof of completeness."""
    joined = sample.alias("s").join(reference.alias("r"), ["address", "slot"], "left")
    same = F.col("s.value").eqNullSafe(F.coalesce("r.value", F.lit(X.ZERO_WORD)))
    return joined.agg(F.count("*").alias("slots_checked"), F.count(F.when(~same, 1)).alias("mismatches")).select(
        F.when(F.col("mismatches") == 0, "sample matches").otherwise("sample differs").alias("status"),
        "slots_checked", "mismatches")
