"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chainfold.session import cut


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node that it reaches.

    Each round hangs a node's larger neighbours, then its smaller ones, under its smallest neighbour, until only
    stars are left (a number of rounds that grows with the logarithm of the path lengths). A node with very many
    neighbours is never gathered: rounds are aggregates and joins that AQE can split. An edge with a null end, or
    from a node to itself, links nothing; an empty table gives no row.
    """
    small, large = F.least(a, b), F.greatest(a, b)
    edges = cut(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                .select(large.alias("u"), small.alias("v")).distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct())
        state = now
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        wide = both.join(least, F.col("u") == F.col("n")).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = wide.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        edges = cut(wide.join(least, F.col("u") == F.col("n")).select(
            F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
            .where("u != v").distinct())
