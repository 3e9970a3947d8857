"""Mixing sources to target weights: shares raised to an exponent, realised as budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainfold.llm.common import query, stored, table

STEPS = 16          # points tried in one job
DIGITS = 6          # the exponent is rounded to so many decimals
BLOCK_TOKENS = 100_000
STRETCH = 4_096     # blocks whose sums one window adds up
SEED = "mix"


def token_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def exponent(shares: DataFrame, entropy_share: float | None = None, max_repeats: float | None = None,
             budget: float = 1.0) -> float:
    """The exponent in [0, 1] for the shares p: q = p ** x / sum(p ** x).

    ``entropy_share``: the largest x at which the entropy of q is at least that part of the entropy of equal weights.
    ``max_repeats``: the smallest x at which no source is read more often than that for ``budget`` times all tokens.
    Where no x reaches the target, the end of [0, 1] that comes closest. The interval is narrowed by trying several points in
    one aggregate; only sums come to the driver, however many sources there are.
    """
    if (entropy_share is None) == (max_repeats is None):
        raise ValueError("give an entropy share or a limit of repetition")
    p = F.col("p")
    low, high = 0.0, 1.0

    def enough(points: list[float]) -> list[bool]:
        """For entropy: is it reached? For repetition: is the limit kept?"""
        asked = [F.count("*").alias("n")]
        for i, x in enumerate(points):
            asked += [F.sum(F.pow(p, F.lit(x))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(x)) * F.log(p)).alias(f"l{i}"),
                      F.max(F.pow(p, F.lit(x - 1))).alias(f"r{i}")]
        row = shares.where("p > 0").agg(*asked).first()
        if not row.n:
            return [True] * len(points)
        if entropy_share is not None:
            return [math.log(row[f"z{i}"]) - x * row[f"l{i}"] / row[f"z{i}"] >= entropy_share * math.log(row.n) - 1e-12
                    for i, x in enumerate(points)]
        return [budget * row[f"r{i}"] / row[f"z{i}"] <= max_repeats for i, x in enumerate(points)]

    wanted = enough([0.0, 1.0])
    if entropy_share is not None and (wanted[1] or not wanted[0]):
        return 1.0 if wanted[1] else 0.0
    if max_repeats is not None and (wanted[0] or not wanted[1]):
        return 0.0 if wanted[0] else 1.0
    while high - low > 10.0 ** -(DIGITS + 3):
        points = [low + (high - low) * (i + 1) / (STEPS + 1) for i in range(STEPS)]
        good = enough(points)
        # entropy falls with x: good points come first; repetition falls too: good points come last
        left = sum(good) if entropy_share is not None else STEPS - sum(good)
        bounds = [low, *points, high]
        low, high = bounds[left], bounds[left + 1]
    return round(low if entropy_share is not None else high, DIGITS)


def mixture(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", budget_share: float = 1.0,
            entropy_share: float | None = 0.95, max_repeats: float | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The rows drawn: doc_id, source, n_tokens, epoch, block, draw_key, exponent. Reading order is epoch, block, draw_key.

    A source with share p of all words gets the weight q (see ``exponent``) and floor(q * budget_share * all words) words
    (a millionth is added first, so that a whole number stays whole). In each
    epoch its documents are dealt anew into blocks of about ``block_tokens`` words by a hash, and ordered by it within
    a block. Full epochs take all documents; the last takes whole blocks while they fit, then from the next block the
    documents before the first that does not fit. No window is wider than one block, STRETCH blocks, or the stretches of a
    source.

    A null source is a source of its own. A null or empty text has no words: its source may get weight 0, which draws
    nothing. Rows that repeat an id are drawn alike where both fit; a null id hashes as no text. An empty table gives no row.
    Other columns are not looked at.
    """
    rows = stored(docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), token_count(text).alias("n_tokens")))
    sums = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    shares = stored(sums.withColumn("p", F.col("tokens") / F.lit(float(max(1, total)))))
    x = exponent(shares, entropy_share, max_repeats, budget_share)
    z = shares.where("p > 0").agg(F.sum(F.pow("p", F.lit(x)))).first()[0] or 1.0
    words = F.floor(F.pow("p", F.lit(x)) / F.lit(z) * F.lit(float(total) * budget_share) + F.lit(1e-6)).cast("long")
    plan = shares.where("p > 0").select(F.col("source").alias("s"), "tokens", words.alias("words")).select(
        "s", F.floor(F.col("words") / F.col("tokens")).cast("long").alias("full"), (F.col("words") % F.col("tokens")).alias("rest"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long").alias("blocks"))
    key = F.md5(F.concat_ws("|", F.lit(SEED), F.col("epoch").cast("string"), F.col("doc_id").cast("string")).cast("binary"))
    dealt = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full")))).withColumn("draw_key", key).withColumn(
        "block", F.conv(F.substring("draw_key", 1, 15), 16, 10).cast("long") % F.col("blocks"))
    columns = ["doc_id", "source", "n_tokens", "epoch", "block", "draw_key"]
    whole = dealt.where("epoch < full").select(*columns)
    last = dealt.where("epoch = full AND rest > 0")
    by_block = stored(last.groupBy("s", "block", "rest").agg(F.sum("n_tokens").alias("inside")).withColumn(
        "stretch", F.floor(F.col("block") / STRETCH)))

    def before(value: str, *keys: str) -> Column:
        return F.coalesce(F.sum(value).over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stretches = by_block.groupBy("s", "stretch").agg(F.sum("inside").alias("all")).select(
        F.col("s").alias("ss"), F.col("stretch").alias("at"), before("all", "s", "stretch").alias("ahead"))
    room = by_block.join(stretches, F.col("s").eqNullSafe(F.col("ss")) & (F.col("stretch") == F.col("at"))).withColumn(
        "left", F.col("rest") - F.col("ahead") - before("inside", "s", "stretch", "block")).where("left >= 0").select(
        F.col("s").alias("bs"), F.col("block").alias("bb"), "inside", "left")
    met = last.join(room, F.col("s").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb")))
    upto = F.sum("n_tokens").over(Window.partitionBy("s", "block").orderBy("draw_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    cut = met.where("inside > left").withColumn("upto", upto).where("upto <= left").select(*columns)
    return whole.unionByName(met.where("inside <= left").select(*columns)).unionByName(cut).withColumn("exponent", F.lit(x))


@query("op4_temperature_mixing", f"""WITH RECURSIVE r AS (SELECT doc_id, source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
s AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM r GROUP BY source),
t AS (SELECT CAST(sum(tokens) AS DOUBLE) AS total, count(*) FILTER (WHERE tokens > 0) AS n FROM s),
p AS (SELECT source, tokens, tokens / total AS p FROM s, t WHERE tokens > 0),
g AS (SELECT list(p) AS ps, any_value(n) AS n FROM p, t),
h AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi UNION ALL
  SELECT i + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END FROM (
    SELECT i, lo, hi, ln(list_sum(list_transform(ps, lambda v: pow(v, (lo + hi) / 2)))) - (lo + hi) / 2
      * list_sum(list_transform(ps, lambda v: pow(v, (lo + hi) / 2) * ln(v))) / list_sum(list_transform(ps, lambda v: pow(v, (lo + hi) / 2)))
      >= 0.95 * ln(n) - 1e-12 AS ok FROM h, g) WHERE i < 40),
e AS (SELECT CASE WHEN -list_sum(list_transform(ps, lambda v: v * ln(v))) >= 0.95 * ln(n) - 1e-12 THEN 1.0 ELSE round(lo, 6) END AS x
  FROM h, g WHERE i = 40),
z AS (SELECT sum(pow(p, x)) AS z FROM p, e),
w AS (SELECT source, tokens, CAST(floor(pow(p, x) / z * total + 1e-6) AS BIGINT) AS words FROM p, e, z, t),
b AS (SELECT source, words // tokens AS full_, words % tokens AS rest, greatest(1, (tokens + {BLOCK_TOKENS - 1}) // {BLOCK_TOKENS}) AS blocks FROM w),
k AS (SELECT doc_id, r.source, n_tokens, full_, rest, blocks, unnest(range(0, full_ + 1)) AS epoch
  FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source),
m AS (SELECT *, md5('{SEED}|' || epoch || '|' || doc_id) AS draw_key FROM k),
d AS (SELECT *, CAST('0x' || substr(draw_key, 1, 15) AS BIGINT) % blocks AS block FROM m),
l AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY block, draw_key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM d)
SELECT doc_id, source, n_tokens, epoch, block, draw_key, x AS exponent FROM l, e WHERE epoch < full_ OR (rest > 0 AND upto <= rest)""")
def op4_temperature_mixing(spark, d):
    return mixture(table(spark, d, "documents"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns and their place: epoch, block, draw_key. Needs doc_id, source and text."""
    mark = F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).cast("string"))
    draws = mixture(docs.select(mark.alias("mark"), "source", "text"), id="mark", **options).select(
        F.col("doc_id").alias("__drawn"), F.col("source").alias("__source"), "epoch", "block", "draw_key").distinct()
    place = ["epoch", "block", "draw_key"]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in place], mark.alias("__mark"))
    return kept.join(draws.hint("shuffle_hash"), (F.col("__mark") == F.col("__drawn")) & F.col("source").eqNullSafe(
        F.col("__source"))).drop("__mark", "__drawn", "__source")
