"""State reconstruction: the newest value per key, resets, overlays and state as of a block.

Inputs are long rows: changes(number, ordinal, address, slot, value) and
resets(number, ordinal, address).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from chainfold import schema as S
from chainfold.functions import scalars as X

FIELDS = {"balance": StringType(), "nonce": S.UINT64, "code_hash": StringType(), "code": StringType()}


def latest_slots(changes: DataFrame) -> DataFrame:
    """Newest value per (address, slot).

    The struct maximum combines on the map side, so one slot holding most of the rows costs one
    row per task in the shuffle. The value is part of the struct, so ties are settled the same way
    in every run.
    """
    best = F.max(F.struct("number", "ordinal", "value")).alias("best")
    return changes.groupBy("address", "slot").agg(best).select("address", "slot", "best.*")


def latest_resets(resets: DataFrame) -> DataFrame:
    """Newest reset per address, and how many there were."""
    return resets.groupBy("address").agg(F.max(X.position()).alias("reset"), F.count("*").alias("reset_count"))


def after_resets(latest: DataFrame, resets: DataFrame) -> DataFrame:
    """Drop slots whose newest write is not after the account's newest reset.

    Reducing first gives the same rows as filtering first (an older write never outlives a newer
    one), and the join then sees one row per slot. No side is forced to broadcast: AQE does so when
    the reset table turns out small, and splits a hot address otherwise.
    """
    cut = latest_resets(resets).select("address", "reset")
    return (latest.join(cut, "address", "left")
            .where(F.col("reset").isNull() | (X.position() > F.col("reset"))).drop("reset"))


def nonzero(state: DataFrame) -> DataFrame:
    """Drop cleared slots. Only valid after the newest value is known."""
    return state.where(F.col("value") != X.ZERO_WORD)


def reduce_state(changes: DataFrame, resets: DataFrame | None) -> DataFrame:
    """Nonzero state after resets: address, slot, number, ordinal, value."""
    latest = latest_slots(changes)
    return nonzero(latest if resets is None else after_resets(latest, resets))


def up_to(rows: DataFrame, end: int, start: int | None = None) -> DataFrame:
    """Inclusive block range; reaches the scan as a pushed filter."""
    if start is not None and start > end:
        raise ValueError("block range ends before it starts")
    bound = F.col("number") <= end
    return rows.where(bound if start is None else (F.col("number") >= start) & bound)


def state_as_of(changes: DataFrame, resets: DataFrame, end: int) -> DataFrame:
    """Changes and resets carry the same bound, else a later reset would erase older state."""
    return reduce_state(up_to(changes, end), up_to(resets, end))


def state_as_of_each(changes: DataFrame, resets: DataFrame, targets: list[int]) -> DataFrame:
    """State at a few named blocks (a parameter, so short by nature) in one pass over the changes: every slot at every target.

    A row goes to the first target that sees it, and the reduction keeps at most one row per key and target, from which
    each target takes the newest up to it. A slot that is cleared, reset or not yet written at a target reads as zero, also
    one first written behind the last target. A table of (address, slot, block) is answered by ``as_of.values_as_of`` instead.
    """
    wanted = sorted(set(targets))
    if not wanted:
        raise ValueError("no target block given")
    marks = F.array(*[F.lit(n).cast("bigint") for n in wanted])
    first_seen = F.array_min(F.filter(marks, lambda n: n >= F.col("number")))

    def per_target(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
        best = F.max(F.struct("number", "ordinal", *fields)).alias("best")
        step = F.when(F.col("target").isNotNull(), F.struct("target", "best"))
        return (rows.withColumn("target", first_seen).groupBy(*keys, "target").agg(best)
                .groupBy(*keys).agg(F.collect_list(step).alias("steps")))

    def carried(steps: str, n: Column) -> Column:
        seen = F.filter(F.col(steps), lambda s: s["target"] <= n)
        return F.array_max(F.transform(seen, lambda s: s["best"]))

    slots = per_target(changes, ["address", "slot"], ["value"])
    cuts = per_target(resets, ["address"], []).withColumnRenamed("steps", "cuts")
    at = F.transform(marks, lambda n: F.struct(n.alias("target"), carried("steps", n).alias("best"), carried("cuts", n).alias("cut")))
    best, cut = F.col("at.best"), F.col("at.cut")
    held = best.isNotNull() & (cut.isNull() | (X.position(best["number"], best["ordinal"]) > X.position(cut["number"], cut["ordinal"])))
    return (slots.join(cuts, "address", "left").select("address", "slot", F.explode(at).alias("at"))
            .select("at.target", "address", "slot", F.when(held, best["value"]).otherwise(F.lit(X.ZERO_WORD)).alias("value")))


def slot_values(state: DataFrame, wanted: DataFrame) -> DataFrame:
    """Values of the asked (address, slot) pairs; a slot never written reads as zero."""
    return wanted.join(state.select("address", "slot", "value"), ["address", "slot"], "left").withColumn(
        "value", F.coalesce("value", F.lit(X.ZERO_WORD)))


# ---------------------------------------------------------------- union of sources

def at_position(rows: DataFrame, number: int) -> DataFrame:
    """A folded table enters the union at the end of the block it was folded to."""
    return rows.select("address", "slot", "value", F.lit(number).cast("bigint").alias("number"),
                       F.lit(0).cast("bigint").alias("ordinal"))


def union_changes(deltas: list[DataFrame], folded: list[tuple[DataFrame, int]] = ()) -> DataFrame:
    """Deltas of all cohorts plus folded prefixes and base, each with its chain position."""
    columns = ["address", "slot", "value", "number", "ordinal"]
    parts = [d.select(*columns) for d in deltas] + [at_position(rows, n) for rows, n in folded]
    if not parts:
        raise ValueError("no source state")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def choose_prefix(start: int, prefix: dict | None) -> dict:
    """Which part of a source to read: a folded prefix plus the blocks behind it, or all blocks."""
    if prefix is None or start > prefix["number"]:
        return {"use_prefix": False, "delta_start": start}
    if start != prefix["start_block"]:
        raise ValueError("requested range begins inside a folded prefix")
    return {"use_prefix": True, "delta_start": prefix["number"] + 1}


def prefix_choices(sources: DataFrame) -> DataFrame:
    """The same decision for a table of sources(start_block, prefix_start, prefix_number)."""
    covered = F.col("prefix_number").isNotNull() & (F.col("start_block") <= F.col("prefix_number"))
    fits = F.col("start_block") == F.col("prefix_start")
    return (sources.withColumn("use_prefix", covered & fits)
            .withColumn("delta_start", F.when(covered & fits, F.col("prefix_number") + 1)
                        .when(~covered, F.col("start_block")))
            .withColumn("inside_prefix", covered & ~fits))


# ---------------------------------------------------------------- account fields

def field_rows(balances: DataFrame, nonces: DataFrame, codes: DataFrame) -> DataFrame:
    """The three kinds as one long table, absent fields NULL."""
    at = ["number", "ordinal", "address"]
    rows = balances.select(*at, F.col("value").cast("string").alias("balance"))
    rows = rows.unionByName(nonces.select(*at, F.col("value").cast(S.UINT64).alias("nonce")),
                            allowMissingColumns=True)
    return rows.unionByName(codes.select(*at, F.col("hash").alias("code_hash"), "code"), allowMissingColumns=True)


def latest_fields(rows: DataFrame, ranked: bool = False, keep_blocks: bool = False) -> DataFrame:
    """Newest known value of each account field, each on its own, in one shuffle.

    A NULL means "not changed here" and never wins; a field no source knows stays NULL.
    ``ranked`` rows carry a ``layer`` column that outranks the chain position.
    """
    order = (["layer"] if ranked else []) + ["number", "ordinal"]
    groups = {"balance": ["balance"], "nonce": ["nonce"], "code": ["code_hash", "code"]}
    best = [F.max(F.when(F.col(names[0]).isNotNull(), F.struct(*order, *names))).alias(f"_{group}")
            for group, names in groups.items()]
    reduced = rows.groupBy("address").agg(*best)
    columns = [F.col(f"_{group}.{name}").alias(name) for group, names in groups.items() for name in names]
    if keep_blocks:
        columns += [F.col(f"_{group}.number").alias(f"{group}_block") for group in groups]
        columns.append(F.greatest(*[F.col(f"_{group}.number") for group in groups]).alias("last_block"))
    return reduced.select("address", *columns)


def overlay_fields(base: DataFrame | None, prefixes: list[DataFrame], observed: DataFrame) -> DataFrame:
    """Base checkpoint, then prefix, then observed changes; the later layer wins field by field."""
    rows = observed.withColumn("layer", F.lit(2))
    zero = F.lit(0).cast("bigint")
    layers = [(base, 0)] + [(p, 1) for p in prefixes]
    for frame, layer in layers:
        if frame is not None:
            rows = rows.unionByName(frame.select("address", *FIELDS).withColumns(
                {"number": zero, "ordinal": zero, "layer": F.lit(layer)}), allowMissingColumns=True)
    return latest_fields(rows, ranked=True)


def fill_from_proof(observed: DataFrame, proven: DataFrame) -> DataFrame:
    """Observed fields stay; unobserved ones come from the proof; contradictions are named."""
    names = [n for n in FIELDS if n in proven.columns and n in observed.columns]
    o, p = observed.alias("o"), proven.alias("p")
    joined = p.join(o, "address", "left")
    differs = F.filter(F.array(*[
        F.when(F.col(f"o.{n}").isNotNull() & ~F.col(f"o.{n}").eqNullSafe(F.col(f"p.{n}")), F.lit(n))
        for n in names if n != "code"]), lambda n: n.isNotNull())
    return joined.select("address", *[F.coalesce(f"o.{n}", f"p.{n}").alias(n) for n in names],
                         differs.alias("mismatched"))


def patch_count(envelopes: DataFrame) -> DataFrame:
    return envelopes.agg(F.coalesce(F.sum(F.size("storage")), F.lit(0)).alias("patches"))


def slot_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("address").agg(F.count("*").alias("nonzero_slots"))
