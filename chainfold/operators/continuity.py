"""Is a block range whole, linked, uniform and anchored? Every defect becomes a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chainfold.functions import scalars as X
from chainfold.operators.ordered import previous_row
from chainfold.session import cut


def check_range(start: int, stop: int) -> tuple[int, int]:
    """Turn ``[start, stop)`` into an inclusive range."""
    if start < 0 or stop <= start:
        raise ValueError(f"[{start}, {stop}) is no range")
    return start, stop - 1


def _announcements(blocks: DataFrame, group: list[str]) -> DataFrame:
    """Each block as itself and as the neighbour that its two neighbours should meet: one pass, no ordering."""
    none = F.lit(None).cast("string")

    def row(shift: int, role: str, hash_, parent, expected):
        return F.struct((F.col("number") + shift).cast("bigint").alias("number"), F.lit(role).alias("role"),
                        hash_.alias("hash"), parent.alias("parent"), expected.alias("expected"))
    three = F.array(row(0, "own", F.col("hash"), F.col("parent_hash"), none), row(1, "after", none, none, F.col("hash")),
                    row(-1, "before", none, none, none))
    return blocks.select(*group, F.inline(three))


def _judged(rows: DataFrame, group: list[str], rivals: str) -> DataFrame:
    """Defects (group, number, last, reason) of announcements; a gap is one row from its first to its last block.

    A number that nobody owns opens a gap if the block before announced it and closes one if the block behind did.
    Opens and closes alternate, so each close ends the gap that the row before it opened. Only numbers with a
    defect are ordered. Missing numbers behind the newest block are not a gap yet.
    """
    def seen(role):
        return F.count(F.when(F.col("role") == role, 1))
    grouped = rows.groupBy(*group, "number").agg(
        seen("own").alias("copies"), seen("after").alias("after"), seen("before").alias("before"),
        F.min("hash").alias("h1"), F.max("hash").alias("h2"), F.min("parent").alias("p1"), F.max("parent").alias("p2"),
        F.min("expected").alias("e1"), F.max("expected").alias("e2"))
    unowned = F.col("copies") == 0
    judged = grouped.select(
        *group, "number", F.expr(rivals).alias("rivals"),
        F.coalesce((F.col("p1") != F.col("e1")) | (F.col("p2") != F.col("e2")), F.lit(False)).alias("unlinked"),
        (unowned & (F.col("after") > 0)).alias("opens"), (unowned & (F.col("before") > 0)).alias("closes"))
    found = cut(judged.where("rivals OR unlinked OR opens OR closes"))
    reason = F.explode(F.array_compact(F.array(F.when(F.col("rivals"), F.lit("conflicting block")),
                                               F.when(F.col("unlinked"), F.lit("broken parent")))))
    edges = previous_row(found.where("opens OR closes").select(*group, "number", "opens", "closes"),
                         group, ["number"], ["number"])
    first = F.when(F.col("opens"), F.col("number")).otherwise(F.col("previous.number"))
    gaps = edges.where("closes").select(*group, first.alias("number"), F.col("number").alias("last"),
                                        F.lit("missing block").alias("reason")).where("number IS NOT NULL")
    return found.select(*group, "number", F.col("number").alias("last"), reason.alias("reason")).unionByName(gaps)


def interval_defects(blocks: DataFrame, start: int, end: int, parent_hash: str | None = None) -> DataFrame:
    """Gaps, conflicts and broken parents within [start, end] as (number, last, reason)."""
    if start > end:
        raise ValueError(f"[{start}, {end}] is no range")
    anchors = blocks.sparkSession.createDataFrame(
        [(start, "after", None, None, parent_hash), (end, "before", None, None, None)],
        "number bigint, role string, hash string, parent string, expected string")
    inside = blocks.where(F.col("number").between(start, end))
    rows = _announcements(inside, []).unionByName(anchors).where(F.col("number").between(start, end))
    return _judged(rows, [], "copies > 1")


def metadata_defects(blocks: DataFrame, accounts: str, producers: tuple[int, int] = (3, 5)) -> DataFrame:
    """Rows whose filter, schema version or producer differs from the declared one."""
    reasons = F.filter(F.array(
        F.when(~F.col("accounts").eqNullSafe(F.lit(accounts)), F.lit("account filter changed")),
        F.when(~F.col("schema_version").eqNullSafe(F.lit(1)), F.lit("schema version changed")),
        F.when(~F.coalesce(F.col("producer_version").between(*producers), F.lit(False)),
               F.lit("other producer version")),
        F.when(~X.is_fixed_hex("hash", 32), F.lit("invalid block hash")),
        F.when(~X.is_fixed_hex("parent_hash", 32), F.lit("invalid parent hash"))), lambda r: r.isNotNull())
    return blocks.select("number", F.explode(reasons).alias("reason"))


def anchor_defects(blocks: DataFrame, header: dict) -> DataFrame:
    """The last block must be the header's block."""
    differs = (F.col("hash") != header["hash"]) | (F.col("state_root") != header["state_root"])
    return blocks.where((F.col("number") == header["number"]) & differs).select(
        "number", F.lit("differs from header").alias("reason"))


def validate_interval(blocks: DataFrame, start: int, header: dict, accounts: str,
                      prefix: dict | None = None, parent_hash: str | None = None) -> DataFrame:
    """All defects of a source interval up to the header, behind an optional folded prefix.

    ``prefix`` has start_block, number, hash and state_root. A prefix that already ends at the
    header needs no blocks but must be that very block.
    """
    end = header["number"]
    none = blocks.sparkSession.createDataFrame([], "number bigint, last bigint, reason string")
    if prefix is not None:
        if start != prefix["start_block"] or prefix["number"] > end:
            return blocks.sparkSession.createDataFrame(
                [(start, end, "range cannot use this folded prefix")], "number bigint, last bigint, reason string")
        start, parent_hash = prefix["number"] + 1, prefix["hash"]
        if start == end + 1:
            same = prefix["hash"] == header["hash"] and prefix["state_root"] == header["state_root"]
            return none if same else blocks.sparkSession.createDataFrame(
                [(end, end, "folded prefix differs from header")], "number bigint, last bigint, reason string")
    inside = blocks.where(F.col("number").between(start, end))
    single = metadata_defects(inside, accounts).unionByName(anchor_defects(inside, header))
    return interval_defects(inside, start, end, parent_hash).unionByName(single.withColumn("last", F.col("number")))


def require_none(defects: DataFrame, what: str) -> None:
    """Fail with the first few defects. Only those few rows reach the driver."""
    found = defects.limit(5).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


# ---------------------------------------------------------------- progress and cohorts

def progress_match(progress: DataFrame, blocks: DataFrame, markers: DataFrame) -> DataFrame:
    """A durable position must meet exactly one data row and one marker with its hash."""
    data = blocks.select("number", F.lit(1).alias("data_row"), F.lit(0).alias("marker_row"),
                         F.lower("hash").alias("found"))
    mark = markers.select("number", F.lit(0).alias("data_row"), F.lit(1).alias("marker_row"),
                          F.concat(F.lit("0x"), F.regexp_replace(F.lower("hash"), "^0x", "")).alias("found"))
    both = data.unionByName(mark).groupBy("number").agg(
        F.sum("data_row").alias("data_rows"), F.sum("marker_row").alias("marker_rows"),
        F.min("found").alias("low"), F.max("found").alias("high"))
    ok = ((F.coalesce("data_rows", F.lit(0)) == 1) & (F.coalesce("marker_rows", F.lit(0)) == 1)
          & F.col("low").eqNullSafe(F.col("hash")) & F.col("high").eqNullSafe(F.col("hash")))
    return progress.join(both, "number", "left").select(
        "run_id", "number", F.coalesce("data_rows", F.lit(0)).alias("data_rows"),
        F.coalesce("marker_rows", F.lit(0)).alias("marker_rows"), ok.alias("matches"))


def progress_regressions(progress: DataFrame) -> DataFrame:
    """Entries of progress(run_id, entry, number) that fall behind the entry before them in their run."""
    from chainfold.operators.ordered import previous_row
    seen = previous_row(progress, ["run_id"], ["entry"], ["number"])
    return seen.where(F.col("number") < F.col("previous.number")).select("run_id", "entry", "number")


def cohort_overlap(cohorts: DataFrame) -> DataFrame:
    """Accounts that appear in more than one cohort(cohort, address)."""
    return (cohorts.groupBy("address").agg(F.min("cohort").alias("first_cohort"), F.max("cohort").alias("last_cohort"))
            .where("first_cohort <> last_cohort"))


def coverage_defects(selected: DataFrame, covered: DataFrame) -> DataFrame:
    """Accounts selected but not covered, or covered but not selected."""
    rows = selected.select("address", F.lit(1).alias("want"), F.lit(0).alias("have")).unionByName(
        covered.select("address", F.lit(0).alias("want"), F.lit(1).alias("have")))
    sides = rows.groupBy("address").agg(F.max("want").alias("want"), F.max("have").alias("have"))
    return sides.where("want <> have").select(
        "address", F.when(F.col("want") == 1, "not covered").otherwise("not selected").alias("reason"))


def continuation_defects(sources: DataFrame, base_accounts: DataFrame, base: dict) -> DataFrame:
    """Cohorts(cohort, address, start_block, parent_hash) holding base accounts must start right
    behind the base block and name it as parent."""
    known = base_accounts.select("address").distinct().withColumn("known", F.lit(True))
    per = (sources.join(known, "address", "left").groupBy("cohort").agg(
        F.max("start_block").alias("start_block"), F.max("parent_hash").alias("parent_hash"),
        F.count("known").alias("known_accounts")))
    wrong_start = F.col("start_block") != base["number"] + 1
    wrong_parent = ~F.col("parent_hash").eqNullSafe(F.lit(base["hash"]))
    return per.where((F.col("known_accounts") > 0) & (wrong_start | wrong_parent)).select(
        "cohort", F.when(wrong_start, "does not start behind the base")
        .otherwise("parent is not the base block").alias("reason"))


# ---------------------------------------------------------------- batches of several sources

def last_blocks(batch: DataFrame, last: DataFrame) -> DataFrame:
    """Newest (number, hash) per source. At one number the carried block stays, not its rival."""
    rows = last.select("source", "number", F.lit(1).alias("carried"), "hash").unionByName(
        batch.select("source", "number", F.lit(0).alias("carried"), "hash"))
    best = F.max(F.struct("number", "carried", "hash")).alias("b")
    return rows.groupBy("source").agg(best).select("source", "b.number", "b.hash")


def link_defects(batch: DataFrame, last: DataFrame) -> DataFrame:
    """Defects (source, number, last, reason) of batch(source, number, hash, parent_hash) behind the carried blocks."""
    none = F.lit(None).cast("string")
    carried = last.select("source", F.col("number").alias("last_number"), F.col("hash").alias("last_hash"))
    placed = batch.join(carried, "source", "left")
    stale = F.coalesce(F.col("number") <= F.col("last_number"), F.lit(False))
    again = (F.col("number") == F.col("last_number")) & (F.col("hash") == F.col("last_hash"))
    late = placed.where(stale & ~again).select("source", "number", F.col("number").alias("last"), F.lit("late block").alias("reason"))
    ends = last.select("source", (F.col("number") + 1).alias("number"), F.lit("after").alias("role"), none.alias("hash"),
                       none.alias("parent"), F.col("hash").alias("expected"))
    rows = _announcements(placed.where(~stale), ["source"]).unionByName(ends)
    # the block before a batch's first one is announced by it, but it may be the carried block
    known = rows.join(carried, "source", "left").where("role <> 'before' OR last_number IS NULL OR number > last_number")
    return _judged(known.select(*rows.columns), ["source"], "copies > 1 AND h1 <> h2").unionByName(late)
