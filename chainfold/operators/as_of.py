"""State at asked positions: a table of requests meets the changes by order, not by a list of targets.

Requests and changes form one ordered sequence per key, and every request takes over the newest change before it. So the
cost is one ordering of both tables, whatever the number of distinct blocks asked for, and the output has one row per request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chainfold.functions import scalars as X
from chainfold.operators.ordered import last_known

_LAST = (1 << 63) - 1


def _with_last(requests: DataFrame, known: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Each request with the newest row of ``known`` (keys, number, ordinal, fields) at or before its block, as struct ``name``."""
    fields = [c for c in known.columns if c not in keys]
    kind = known.select(F.struct(*fields).alias("k")).schema["k"].dataType
    none = F.lit(None)
    asked = requests.select(*keys, F.col("block").alias("_number"), F.lit(_LAST).alias("_ordinal"), none.cast(kind).alias("_known"),
                            F.struct(*requests.columns).alias("_asked"))
    told = known.select(*keys, F.col("number").alias("_number"), F.col("ordinal").alias("_ordinal"), F.struct(*fields).alias("_known"),
                        none.cast(asked.schema["_asked"].dataType).alias("_asked"))
    placed = last_known(told.unionByName(asked), keys, ["_number", "_ordinal"], "_known", name)
    return placed.where("_asked IS NOT NULL").select("_asked.*", name)


def _at(position: Column) -> Column:
    return X.position(position["number"], position["ordinal"])


def values_as_of(changes: DataFrame, resets: DataFrame | None, requests: DataFrame) -> DataFrame:
    """The requests (address, slot, block, ...) with ``value``: what the slot held at the end of the block.

    A slot never written by then reads as zero, and so does one whose newest write is not behind the account's newest
    reset by then. Repeated requests are answered each. Columns beyond the keys travel with the request. Neither a busy
    account nor a busy slot is gathered: both orders run over ranges.
    """
    answered = _with_last(requests, changes.select("address", "slot", "number", "ordinal", "value"), ["address", "slot"], "_write")
    written = F.col("_write").isNotNull()
    if resets is not None:
        answered = _with_last(answered, resets.select("address", "number", "ordinal"), ["address"], "_reset")
        written = written & (F.col("_reset").isNull() | (_at(F.col("_write")) > _at(F.col("_reset"))))
    value = F.when(written, F.col("_write.value")).otherwise(F.lit(X.ZERO_WORD))
    return answered.select(*requests.columns, value.alias("value"))


def fields_as_of(rows: DataFrame, requests: DataFrame, fields: list[str]) -> DataFrame:
    """The requests (address, block, ...) with the newest known value of each account field at the end of the block.

    ``rows`` are (number, ordinal, address, fields), a null meaning "not changed here". A field nobody wrote by then is null.
    """
    answered = requests
    for field in fields:
        known = rows.where(F.col(field).isNotNull()).select("address", "number", "ordinal", field)
        answered = _with_last(answered, known, ["address"], f"_{field}")
    return answered.select(*requests.columns, *[F.col(f"_{field}.{field}").alias(field) for field in fields])
