"""Linking within buckets: similar members are found without writing down all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK = 1024


def forest(close: Callable[[int], np.ndarray], n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest; close(i) tells which of the n members are within reach of member i."""
    left, out = np.ones(n, bool), []
    for first in range(n):
        if not left[first]:
            continue
        left[first], open_ = False, [first]
        while open_ and left.any():
            i = open_.pop()
            new = np.flatnonzero(close(i) & left)
            left[new] = False
            out += [(i, int(j)) for j in new]
            open_ += new.tolist()
    return out


def linked(rows: DataFrame, payload: DataFrame, close: Callable[[list[np.ndarray]], Callable[[int], np.ndarray]],
           pairs: Callable[[list[np.ndarray], np.ndarray, np.ndarray], np.ndarray] | None = None, block: int = BLOCK,
           label: str | None = None) -> DataFrame:
    """Edges (a, b) that connect, in each bucket of ``rows`` (key, node), the members that are close to each other.

    Two members of a bucket end up connected exactly if a chain of close members of that bucket joins them: a
    bucket yields a spanning forest, at most one edge a member and block. ``payload`` (node and what ``close`` compares) is
    joined once a bucket is known to have several members; a node is in a bucket once. A bucket of more than
    ``block`` members is dealt into blocks of about that size, and each pair of blocks is compared in its own
    group, so no task holds more than a few blocks at once, whatever the bucket. ``pairs`` may tell for many
    buckets of two at once whether their members are close. With ``label``, a column of ``payload`` that is equal for nodes
    known to be connected, edges join labels instead of nodes, and those within a label are left out.
    """
    node = payload.columns[0]
    name = payload.columns if label is None else [label, *[c for c in payload.columns[1:] if c != label]]
    counts = rows.groupBy(F.col("key").alias("_k")).agg(F.count("*").alias("_n")).where("_n > 1")
    parts = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64("_node", F.lit(7)), parts).cast("int")
    members = rows.join(counts, F.col("key") == F.col("_k")).select("_k", "_n", F.col("node").alias("_node"))
    dealt = members.join(payload, F.col("_node") == F.col(node)).withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        F.xxhash64(F.lit(1), "_k", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("_g"), "_k", *name)
    return forests(dealt, name, close, pairs)


def forests(dealt: DataFrame, name: list[str], close: Callable[[list[np.ndarray]], Callable[[int], np.ndarray]],
            pairs: Callable[[list[np.ndarray], np.ndarray, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Edges of a spanning forest of each group (_g, _k) of ``dealt``; the first column of ``name`` is a member's label.

    Members are taken by ascending label, so that buckets with common members hang them under the same one and give the
    same edges. Edges between equal labels are left out.
    """
    node = name[0]
    schema = dealt.select(F.col(node).alias("a"), F.col(node).alias("b")).schema

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            whole = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            group, bucket = (whole.column(c).to_numpy() for c in ("_g", "_k"))
            starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (bucket[1:] != bucket[:-1])])
            rest = whole.slice(starts[-1])
            yield from run(whole.slice(0, starts[-1]), starts)
        if rest is not None:
            yield from run(rest, np.array([0, len(rest)]))

    def run(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.diff(starts)
        columns = [rows.column(c).to_numpy() for c in name]
        left, right, least = [], [], 1
        if pairs is not None and (two := starts[:-1][sizes == 2]).size:
            found = two[pairs(columns, two, two + 1)]
            left, right, least = found.tolist(), (found + 1).tolist(), 2
        for at, n in zip(starts[:-1][sizes > least].tolist(), sizes[sizes > least].tolist(), strict=True):
            for i, j in forest(close([c[at:at + n] for c in columns]), n):
                left.append(at + i)
                right.append(at + j)
        if left:
            ids = rows.column(node).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(left)), ids.take(pa.array(right))], names=["a", "b"])

    return dealt.repartition("_g").sortWithinPartitions("_g", "_k", node).mapInArrow(edges, schema).where("a != b").distinct()
