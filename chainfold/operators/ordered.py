"""Order-dependent operators for groups too large for one task.

A plain window puts a whole group into one task. Here rows are range-partitioned by (group, order),
each range is handled on its own, and only the ranges' borders (at most one row per range) travel.
The ranged rows are written to the shared checkpoint folder first, so a retried task can never see
other range borders than the ones the offsets were computed from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainfold.session import cut

_PART, _PLACE, _TIE = "_part", "_place", "_tie"


def _ranged(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    keys = [*group, *order]
    return cut(rows.repartitionByRange(*keys).withColumn(_PART, F.spark_partition_id()))


def _local(group: list[str], order: list[str]) -> Window:
    return Window.partitionBy(_PART, *group).orderBy(*order)


def _with_border(local: DataFrame, border: DataFrame, group: list[str]) -> DataFrame:
    """A range continues at most one group of an earlier range, so the border table has at most one
    row per range and may be broadcast. NULL group keys match each other."""
    keys = [*group, _PART]
    side = border.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)],
                         *[c for c in border.columns if c not in keys])
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_b{i}"))
    return local.join(F.broadcast(side), match, "left").drop(*[f"_b{i}" for i in range(len(keys))])


def _same_keys(keys: list[str]) -> Column:
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_e{i}"))
    return match


def running_totals(rows: DataFrame, group: list[str], order: list[str], amounts: dict[str, Column],
                   total: str | None = None) -> DataFrame:
    """Inclusive running sums per group, one column for each entry of ``amounts``, in one pass. Order keys must be unique.

    ``total`` names a column that repeats the group's whole sum of the first amount, made from the ranges' sums.
    """
    ranged, first = _ranged(rows, group, order), next(iter(amounts))
    per_range = ranged.groupBy(*group, _PART).agg(*[F.sum(step).alias(name) for name, step in amounts.items()])
    # At most one row per (group, range); only groups that cross a border keep an offset.
    before = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(*group, _PART, F.count(F.lit(1)).over(before).alias("_ranges"),
                               *[F.sum(name).over(before).alias(f"_before_{name}") for name in amounts]
                               ).where("_ranges > 0").drop("_ranges")
    here = _local(group, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(step).over(here).alias(f"_here_{name}") for name, step in amounts.items()])
    placed = _with_border(local, offsets, group)
    placed = placed.select(*rows.columns, *[
        (F.col(f"_here_{name}") + F.coalesce(f"_before_{name}", F.lit(0))).alias(name) for name in amounts])
    if total is None:
        return placed
    sums = per_range.groupBy(*[F.col(g).alias(f"_of_{g}") for g in group]).agg(F.sum(first).alias(total))
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group]      # a NULL group is a group
    return placed.join(sums, same).drop(*[f"_of_{g}" for g in group])


def running_total(rows: DataFrame, group: list[str], order: list[str], amount: str | None = None,
                  name: str = "running", total: str | None = None) -> DataFrame:
    """Inclusive running sum of ``amount`` (1 when None) per group; see ``running_totals``."""
    step = F.col(amount) if amount else F.lit(1).cast("bigint")
    return running_totals(rows, group, order, {name: step}, total)


def row_rank(rows: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """1-based row number per group."""
    return running_total(rows, group, order, None, name)


def previous_row(rows: DataFrame, group: list[str], order: list[str], values: list[str],
                 name: str = "previous") -> DataFrame:
    """The preceding row of the group as one struct column, NULL for the first row.

    Rows with equal order keys follow each other in any order; a row number keeps many such rows
    from landing in one range.
    """
    order = [*order, _TIE]
    ranged = _ranged(rows.withColumn(_TIE, F.monotonically_increasing_id()), group, order)
    payload = F.struct(*values)
    last = (ranged.groupBy(*group, _PART)
            .agg(F.max(F.struct(*order, payload.alias(_PLACE))).alias("_last")))
    carry = (last.withColumn("_carry", F.lag(f"_last.{_PLACE}").over(
        Window.partitionBy(*group).orderBy(_PART))).where("_carry IS NOT NULL").drop("_last"))
    local = ranged.withColumn("_here", F.lag(payload).over(_local(group, order)))
    return (_with_border(local, carry, group)
            .withColumn(name, F.coalesce("_here", "_carry")).drop("_here", "_carry", _PART, _TIE))


def last_known(rows: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The newest value of column ``value`` that is not NULL, up to and with the row itself; NULL before the first.

    Rows with equal order keys follow each other in any order. Only each range's last value travels, one row per range.
    """
    order = [*order, _TIE]
    ranged = _ranged(rows.withColumn(_TIE, F.monotonically_increasing_id()), group, order)
    ends = (ranged.where(F.col(value).isNotNull()).groupBy(*group, _PART)
            .agg(F.max_by(value, F.struct(*order)).alias("_end")))
    here = _local(group, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_here", F.last(value, ignorenulls=True).over(here))
    # a range without a value of the group hands on what it was handed
    spans = ranged.groupBy(*group, _PART).agg(F.lit(1).alias("_one")).drop("_one").join(
        ends.withColumnsRenamed({k: f"_e{i}" for i, k in enumerate([*group, _PART])}),
        _same_keys([*group, _PART]), "left")
    before = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = (spans.select(*group, _PART, F.last("_end", ignorenulls=True).over(before).alias("_carry"))
             .where("_carry IS NOT NULL"))
    return _with_border(local, carry, group).withColumn(name, F.coalesce("_here", "_carry")).drop("_here", "_carry", _PART, _TIE)


def nearest_rank(samples: DataFrame, group: list[str], value: str,
                 levels: dict[str, float]) -> DataFrame:
    """Exact nearest-rank percentiles with count, minimum and maximum per group.

    Equal values are counted before any ordering, and the rank is found by a distributed running
    total, so neither a repeated value nor a huge group gathers in one task. NULL, NaN and infinite
    observations are an error.
    """
    v = F.col(value).cast("double")
    bad = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    keys, group = list(group), list(group) or ["_all"]
    if not keys:
        samples = samples.withColumn("_all", F.lit(0))
    checked = samples.select(*group, F.when(bad, F.raise_error(F.lit("non-finite observation")).cast("double"))
                             .otherwise(v).alias("_v"))
    counts = checked.groupBy(*group, "_v").agg(F.count("*").alias("_n"))
    placed = running_total(counts, group, ["_v"], "_n", "_upto", "_all_rows")
    return placed.groupBy(*group).agg(
        F.max("_all_rows").alias("samples"), F.min("_v").alias("min"),
        *[F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all_rows") * F.lit(level)), F.col("_v"))).alias(name)
          for name, level in levels.items()], F.max("_v").alias("max")).select(*keys, "samples", "min", *levels, "max")
