"""Filter nested blocks by a table of accounts of any size: a bitmap inside the row, the exact join behind it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 1 << 20          # 128 KB, whatever the table; with a million accounts most changes pass on to the exact join


def table_bitmap(accounts: DataFrame, bits: int = BITS) -> Column:
    """A bit for each hashed ``address`` (hex text), as words of 64 bits: a scalar subquery of fixed size.

    Addresses only meet as bits, combined on the map side, so the table may be as large as it likes.
    """
    place = F.pmod(F.xxhash64(F.unhex(F.substring("address", 3, 1 << 30))), F.lit(bits))
    words = (accounts.where("address IS NOT NULL").select(place.alias("place"))
             .groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits")))
    whole = accounts.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("word"), "left").agg(
        F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("words"))
    return whole.select(F.transform("words", lambda w: w["bits"])).scalar()


def may_hold(bitmap: Column, address: Column, bits: int = BITS) -> Column:
    """False only for an address (bytes) that the table surely lacks."""
    place = F.pmod(F.xxhash64(address), F.lit(bits))
    word = F.get(bitmap, F.floor(place / 64).cast("int"))
    return F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def of_either(rows: DataFrame, accounts: DataFrame, first: str, second: str) -> DataFrame:
    """Rows whose one or other address (hex text) is in the table, each once."""
    chosen = accounts.select("address").distinct()
    own = chosen.select(F.col("address").alias("_one"), F.lit(True).alias("_by_one"))
    other = chosen.select(F.col("address").alias("_two"), F.lit(True).alias("_by_two"))
    return (rows.join(own, F.col(first) == F.col("_one"), "left").join(other, F.col(second) == F.col("_two"), "left")
            .where("_by_one OR _by_two").select(*[F.col(f"`{c}`") for c in rows.columns]))


def table_name(accounts: DataFrame) -> Column:
    """What an envelope says about a table it was filtered by: the number of accounts and a sum over their hashes."""
    rows = accounts.select("address").distinct().select(F.xxhash64("address").cast("decimal(20,0)").alias("h"))
    name = F.concat(F.lit("table:"), F.count("*").cast("string"), F.lit(":"), F.coalesce(F.sum("h"), F.lit(0)).cast("string"))
    return rows.agg(name.alias("name")).scalar()
