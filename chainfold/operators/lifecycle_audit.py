"""Block lifecycle audit: what nested blocks destroyed, and how accounts changed across a block, against declared claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chainfold.operators import as_of, block_end as E, quality as Q

FIELDS = ["balance", "nonce", "code_hash"]
DELETED, EQUAL, DIFFERENT = "deleted", "equal", "different"


def block_sides(rows: DataFrame, asked: DataFrame, fields: list[str]) -> DataFrame:
    """The rows of asked(number, address, field, ...) with the field's value ``before`` and ``after`` the block.

    Both sides of all asked fields are requests of one as-of pass per field over rows(number, ordinal, address, fields).
    """
    keys = asked.columns
    requests = asked.distinct().select("*", F.explode(F.array(
        F.struct((F.col("number") - 1).alias("block"), F.lit("before").alias("side")),
        F.struct(F.col("number").alias("block"), F.lit("after").alias("side")))).alias("s")).select(*keys, "s.*")
    known = as_of.fields_as_of(rows, requests, [f for f in fields])
    value = F.coalesce(*[F.when(F.col("field") == f, F.col(f).cast("string")) for f in fields])
    side = lambda name: F.max(F.when(F.col("side") == name, value)).alias(name)
    return known.groupBy(*keys).agg(side("before"), side("after"))


def lifecycle_audit(blocks: DataFrame, rows: DataFrame, claims: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """(number, address, reason) of every declared claim that does not hold, and of every deletion nobody declared.

    ``claims`` are (number, address, field, must): a field must be ``equal`` or ``different`` before and after the block,
    or, without a field, the account must be ``deleted`` in it. Deletions follow from the blocks' committed destroying
    calls, the accounts they ran as, and what was created in the same transaction. Repeated claims count once; a
    block or account that the data does not know has no value on either side.
    """
    removed = E.deletions(E.destroying_calls(blocks)).select("number", "address", F.lit(1).alias("found"), F.lit(0).alias("declared"))
    declared = claims.where(F.col("must") == DELETED).select("number", "address", F.lit(0).alias("found"), F.lit(1).alias("declared"))
    unequal = removed.unionByName(declared).groupBy("number", "address").agg(
        F.max("found").alias("found"), F.max("declared").alias("declared")).where("found <> declared").select(
        "number", "address", F.when(F.col("found") == 1, "deleted but not declared").otherwise("declared but not deleted").alias("reason"))
    asked = claims.where(F.col("must").isin(EQUAL, DIFFERENT)).select("number", "address", "field", "must")
    wrong = Q.side_claims(block_sides(rows, asked, fields), fields)
    return unequal.unionByName(wrong.select("number", "address", F.concat("field", F.lit(" is not "), "must").alias("reason")))
