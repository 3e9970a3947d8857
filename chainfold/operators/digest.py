"""Checksums of whole tables that need no global order and no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LIMBS = 4
LIMB_DIGITS = 15          # 60 bits: a positive BIGINT


def row_hash(*columns: str | Column) -> Column:
    text = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat(*text), 256)


def state_digest(state: DataFrame) -> DataFrame:
    """sha256 tree over all rows, the same for every order and partitioning.

    Rows are spread by the hash of their key over 16^6 leaves, leaves over 16^3 branches. The shape
    is fixed, so no group grows beyond (rows / 16M) or 4096 entries, whatever account dominates.
    """
    rows = state.select(
        F.substring(row_hash("address", "slot"), 1, 6).alias("leaf"),
        row_hash("address", "slot", "value").alias("h"))
    leaves = rows.groupBy("leaf").agg(
        F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"))
    return _fold(leaves)


def _fold(leaves: DataFrame) -> DataFrame:
    def joined(key: str) -> Column:
        items = F.array_sort(F.collect_list(F.concat(key, "h")))
        return F.sha2(F.array_join(items, ""), 256).alias("h")
    branches = leaves.groupBy(F.substring("leaf", 1, 3).alias("branch")).agg(
        F.sum("n").alias("n"), joined("leaf"))
    return branches.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("nonzero_slots"), joined("branch")).select(
        F.col("h").alias("state_sha256"), "nonzero_slots")


def account_digest(accounts: DataFrame) -> DataFrame:
    """The same tree over account rows; every field enters the hash, with NULL kept apart from ''."""
    names = [n for n in sorted(accounts.columns) if n != "address"]
    fields = [F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("~")) for n in names]
    body = F.sha2(F.concat_ws("|", F.col("address"), *fields), 256)
    rows = accounts.select(F.substring(row_hash("address"), 1, 6).alias("leaf"), body.alias("h"))
    leaves = rows.groupBy("leaf").agg(
        F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"))
    return _fold(leaves).select(F.col("state_sha256").alias("accounts_sha256"), F.col("nonzero_slots").alias("rows"))


def fingerprint(rows: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """Additive row fingerprint per key: count and four exact sums of hash digits.

    It combines on the map side, so it shuffles one row per task and key. Two multisets are equal
    when counts and sums are equal.
    """
    h = F.col("_h")
    sums = [F.sum(F.conv(F.substring(h, 1 + LIMB_DIGITS * i, LIMB_DIGITS), 16, 10).cast("bigint")
                  .cast("decimal(38,0)")).cast("string").alias(f"sum{i}") for i in range(LIMBS)]
    hashed = rows.select(*keys, row_hash(*columns).alias("_h"))
    counted = F.count("*").alias("rows")
    return hashed.groupBy(*keys).agg(counted, *sums) if keys else hashed.agg(counted, *sums)


def same_rows(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """One row: do both sides hold the same rows, duplicates counted?"""
    sided = (left.select(*columns).withColumn("_side", F.lit(0))
             .unionByName(right.select(*columns).withColumn("_side", F.lit(1))))
    prints = fingerprint(sided, columns, ["_side"])
    names = ["rows"] + [f"sum{i}" for i in range(LIMBS)]
    equal = [F.coalesce(F.max(F.when(F.col("_side") == 0, F.col(n))), F.lit("0").cast(prints.schema[n].dataType))
             == F.coalesce(F.max(F.when(F.col("_side") == 1, F.col(n))), F.lit("0").cast(prints.schema[n].dataType))
             for n in names]
    condition = equal[0]
    for one in equal[1:]:
        condition = condition & one
    return prints.agg(
        F.coalesce(F.max(F.when(F.col("_side") == 0, F.col("rows"))), F.lit(0)).alias("left_rows"),
        F.coalesce(F.max(F.when(F.col("_side") == 1, F.col("rows"))), F.lit(0)).alias("right_rows"),
        condition.alias("equal"))
