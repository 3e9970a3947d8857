"""Views of the given tables as chain data, once for Spark and once as SQL.

Events are changes: 100 events form a block, so the number of blocks grows with the table while a
block stays small. A ``signup`` resets its account's storage; an ``error`` clears its slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.functions import scalars as X
from chainfold.session import ship

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, the SQL with the same result."""
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # The session may come from elsewhere: the tables' wall-clock times are read as UTC.
    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


BLOCK_SIZE = 100


def events(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """All events, or those of the blocks up to ``upto``: the bound is one on the stored column, so it reaches the scan."""
    zero = F.lit(X.ZERO_WORD)
    k = F.get_json_object("props", "$.k").cast("bigint")
    stored = table(spark, folder, "events")
    if upto is not None:
        stored = stored.where(F.col("event_id") < (upto + 1) * BLOCK_SIZE)
    return stored.select(
        F.expr(f"event_id div {BLOCK_SIZE}").alias("number"), F.col("event_id").alias("ordinal"),
        X.number_word("user_id", 40).alias("address"), X.number_word(k).alias("slot"),
        F.when(F.col("event_type") == "error", zero).otherwise(X.number_word(F.col("event_id") + 1)).alias("value"),
        "event_type", "user_id", k.alias("k"), F.round(F.col("value") * 100).cast("bigint").alias("cents"), "ts", "props")


def changes(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    return events(spark, folder, upto).where("event_type <> 'signup'").select(
        "number", "ordinal", "address", "slot", "value")


def resets(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    return events(spark, folder, upto).where("event_type = 'signup'").select("number", "ordinal", "address")


def address_of(column) -> "Column":
    return X.number_word(column, 40)


def sql_address(expression: str) -> str:
    return f"('0x' || lpad(lower(to_hex({expression})), 40, '0'))"


def sql_word(expression: str) -> str:
    return f"('0x' || lpad(lower(to_hex({expression})), 64, '0'))"


ZERO = X.ZERO_WORD
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
EV = f"""ev AS (SELECT event_id // {BLOCK_SIZE} AS number, event_id AS ordinal, {sql_address('user_id')} AS address,
  {sql_word(K)} AS slot,
  CASE WHEN event_type = 'error' THEN '{ZERO}' ELSE {sql_word('event_id + 1')} END AS value,
  event_type, user_id, {K} AS k, CAST(round(value * 100) AS BIGINT) AS cents, ts, props FROM events),
ch AS (SELECT number, ordinal, address, slot, value FROM ev WHERE event_type <> 'signup'),
rs AS (SELECT number, ordinal, address FROM ev WHERE event_type = 'signup')"""
# Newest value per slot that outlives the newest reset, zeros still present.
LATEST = """la AS (SELECT address, slot, max((number, ordinal)) AS p, arg_max(value, (number, ordinal)) AS value
  FROM ch GROUP BY address, slot),
rc AS (SELECT address, max((number, ordinal)) AS r FROM rs GROUP BY address),
st AS (SELECT la.address, la.slot, la.value FROM la LEFT JOIN rc ON la.address = rc.address
  WHERE rc.r IS NULL OR la.p > rc.r)"""
