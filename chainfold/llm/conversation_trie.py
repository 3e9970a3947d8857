"""Conversation prefix trie: Spark SQL ROLLUP over positional turn columns aggregates all prefixes together."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chainfold.llm.common import query, stored, table
from chainfold.operators import ordered

WIDTH = 8                       # turns in one block of columns
PIECES = ("a", "b", "c", "d")   # 31 bits of a turn's hash each: sums over four billion turns stay within a bigint
HEAD, SPAN = 6, 100             # a rebuilt conversation takes up to HEAD - 1 first turns of the first of its SPAN


def turns_of(chats: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv_id, at, said, chars): the turns numbered from 1 in their order, each as the SHA-256 of its role and text.

    Turns are ordered by turn (null first); turns of one number by that hash. A null role or text counts as empty;
    repeated rows are repeated turns. Rows without a conversation belong to none and are left out. Numbers are running
    counts over ranges, so that a conversation with a third of all turns is spread over many tasks.
    """
    name, words = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.concat(F.char_length(name).cast("string"), F.lit(":"), name, words)
    rows = chats.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.unhex(F.sha2(whole, 256)).alias("said"),
        F.char_length(words).cast("long").alias("chars"), F.monotonically_increasing_id().alias("tie"))
    placed = ordered.row_rank(rows, ["conv_id"], ["turn", "said", "tie"], "at")
    return stored(placed.select("conv_id", "at", "said", "chars"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and members of conversations that take their head from another one.

    Conversation c gets the first h turns of conversation c - c % SPAN (all it has if fewer, none if it is absent), then
    its own turns after its first h; h is crc32 of c as text, modulo HEAD. Members are (conv_id, length), those left
    without turns included. A head is a few turns, so the conversation that lends it is never gathered.
    """
    lent = (turns.where((F.col("at") < HEAD) & (F.col("conv_id") % SPAN == 0)).groupBy(F.col("conv_id").alias("lender"))
            .agg(F.sort_array(F.collect_list(F.struct("at", "said", "chars"))).alias("head")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("h", h)
    plan = stored(convs.join(lent, F.col("conv_id") - F.col("conv_id") % SPAN == F.col("lender"), "left").select(
        "conv_id", "own", "h", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.expr(
            "CAST(array() AS array<struct<at:bigint,said:binary,chars:bigint>>)")).alias("head")))
    keys = plan.select(F.col("conv_id").alias("of"), "h", F.size("head").alias("got"))
    own = turns.join(keys, F.col("conv_id") == F.col("of")).where("at > h").select(
        "conv_id", (F.col("at") - F.col("h") + F.col("got")).alias("at"), "said", "chars")
    given = plan.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.at", "t.said", "t.chars")
    members = plan.select("conv_id", (F.greatest(F.col("own") - F.col("h"), F.lit(0)) + F.size("head")).alias("length"))
    return own.unionByName(given), members


def _blocks(turns: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, block, prior, upto, t0..): a row for each WIDTH turns of a conversation.

    ``prior`` is the node before the block, ``upto`` the node at its end. A node is named by the sums of its turns'
    hashes, each made with the turn's place, and by the characters up to it. Sums run over ranges of blocks, so every block
    knows its node without waiting for the one before. Each conversation has a block 0, without turns if it has none.
    """
    digest = F.sha2(F.concat(F.col("at").cast("string").cast("binary"), F.lit(b":"), F.col("said")), 256)
    piece = lambda i: F.pmod(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long"), F.lit(1 << 31))
    slots = turns.select("conv_id", F.expr(f"(at - 1) div {WIDTH}").alias("block"), F.struct(
        ((F.col("at") - 1) % WIDTH).alias("slot"), F.struct(
            *[piece(i).alias(p) for i, p in enumerate(PIECES)], "chars").alias("turn")).alias("s"))
    marks = members.select("conv_id", F.lit(0).cast("long").alias("block"), F.lit(None).cast(slots.schema["s"].dataType).alias("s"))
    # at most WIDTH turns and one mark meet in a group
    rows = slots.unionByName(marks).groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list("s")).alias("list"),
        *[F.coalesce(F.sum(f"s.turn.{p}"), F.lit(0)).alias(f"own_{p}") for p in (*PIECES, "chars")])
    names = (*PIECES, "chars")
    summed = ordered.running_totals(rows, ["conv_id"], ["block"], {p: F.col(f"own_{p}") for p in names})
    return stored(summed.select(
        "conv_id", "block", F.struct(*[(F.col(p) - F.col(f"own_{p}")).alias(p) for p in names]).alias("prior"),
        F.struct(*names).alias("upto"), *[F.get("list", F.lit(i)).getField("turn").alias(f"t{i}") for i in range(WIDTH)]))


def _rolled(blocks: DataFrame, aggregates: str) -> DataFrame:
    """One row per node: depth, node, parent, and the aggregates over its members.

    One ROLLUP over the turn columns covers every block at once; the grouping id tells how many columns a row keeps.
    Rows whose last kept column holds no turn belong to conversations that ended before, and a block's row without
    columns is the node that the block before has made; only the root is taken from there.
    """
    columns, names = [f"t{i}" for i in range(WIDTH)], (*PIECES, "chars")
    rolled = blocks.sparkSession.sql(f"""SELECT block, prior, {', '.join(columns)},
        {WIDTH} - bit_count(grouping_id()) AS kept, {aggregates}
        FROM {{blocks}} GROUP BY block, prior, ROLLUP({', '.join(columns)})""", blocks=blocks)
    sums = {p: sum((F.coalesce(f"{t}.{p}", F.lit(0)) for t in columns), F.col(f"prior.{p}")) for p in names}
    last = F.get(F.array(*columns), F.col("kept") - 1)
    before = {p: sums[p] - F.coalesce(last.getField(p), F.lit(0)) for p in names}
    return rolled.where(last.isNotNull() | (F.col("kept") + F.col("block") == 0)).select(
        (F.col("block") * WIDTH + F.col("kept")).alias("depth"), F.struct(*[c.alias(p) for p, c in sums.items()]).alias("node"),
        F.struct(*[c.alias(p) for p, c in before.items()]).alias("parent"), *rolled.columns[3 + WIDTH:])


def _list_hashes(ends: DataFrame) -> DataFrame:
    """(node, sha): SHA-256 of the comma-joined ids of each node, in ascending order, fed as a stream.

    A SHA-256 is sequential, so one node's ids pass one task in order; only a running hash is held, never the list.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, hashed = None, None
        for batch in batches:
            keys, sha = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node == open_:
                    hashed.update(b"," + text.encode())
                    continue
                if open_ is not None:
                    keys.append(open_)
                    sha.append(hashed.hexdigest())
                open_, hashed = node, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sha, pa.string())], names=["key", "sha"])
        if open_ is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_], pa.binary()), pa.array([hashed.hexdigest()], pa.string())], names=["key", "sha"])
    return ends.repartition("key").sortWithinPartitions("key", "conv_id").select(
        "key", F.col("conv_id").cast("string")).mapInArrow(run, "key binary, sha string")


def _key(node: str) -> Column:
    """A node's name as bytes, to join by."""
    return F.unhex(F.sha2(F.concat_ws(",", *[F.col(f"{node}.{p}").cast("string") for p in (*PIECES, "chars")]), 256))


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` are (conv_id, at, said, chars) with places from 1 without gaps, ``members`` (conv_id, length) the conversations,
    also those without turns. Conversations that start with the same turns share nodes. A member's nodes below its
    longest prefix shared with a smaller member are its own, so the smallest member and the depth name a node.

    Two ROLLUPs do the work. The first finds each node's smallest member, hence where each conversation's own nodes begin
    (depth ``own``, ``shared`` characters before it) and whether its last node is a leaf. The second adds these up over the
    members of every node. What sharing saves in a subtree is, for each member but the smallest, the characters it shares
    from that node on, so no sum ever walks the tree, whatever its depth. Without members there is no node.
    """
    blocks = _blocks(turns, members)
    lengths = members.select(F.col("conv_id").alias("of"), "length")
    first = _rolled(blocks.join(lengths, F.col("conv_id") == F.col("of")), "min(conv_id) AS conv_id, max(length) AS longest")
    owned = first.groupBy(F.col("conv_id").alias("owner")).agg(
        F.min("depth").alias("own"), F.min("parent.chars").alias("shared"),
        F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"))
    last = blocks.groupBy("conv_id").agg(*[F.max(f"upto.{p}").alias(p) for p in (*PIECES, "chars")])
    shares = stored(last.join(lengths, F.col("conv_id") == F.col("of")).join(owned, F.col("conv_id") == F.col("owner"), "left").select(
        F.col("conv_id").alias("member"), F.coalesce("own", F.col("length") + 1).alias("own"), F.coalesce("shared", "chars").alias("shared"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"), F.struct(*PIECES, "chars").alias("end")))
    nodes = stored(_rolled(blocks.join(shares.drop("end"), F.col("conv_id") == F.col("member")), """min(conv_id) AS conv_id,
        count(1) AS n_convs, min(own) AS own, min(shared) AS least, sum(shared) AS shares, sum(leaf) AS n_leaves""").select(
        "conv_id", "depth", "own", "n_convs", "n_leaves", _key("node").alias("key"), _key("parent").alias("above"),
        (F.col("shares") - F.col("least") - (F.col("n_convs") - 1) * F.col("parent.chars")).alias("saved_tokens")))
    # only the first own node of a conversation hangs on a node of another one
    named = nodes.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    branch = nodes.where("depth > 0 AND depth = own").join(named, F.col("above") == F.col("up")).drop("up")
    whole = stored(nodes.where("depth = 0 OR depth > own").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id"))).unionByName(branch).drop("above", "own"))
    children = whole.where("depth > 0").groupBy(F.col("parent_conv_id").alias("p"), (F.col("depth") - 1).alias("d")).agg(
        F.count("*").alias("n_children"))
    ends = _list_hashes(shares.select(_key("end").alias("key"), F.col("member").alias("conv_id"))).withColumnRenamed("key", "end")
    return whole.join(children, (F.col("conv_id") == F.col("p")) & (F.col("depth") == F.col("d")), "left").join(
        ends, F.col("key") == F.col("end"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


# crc32 of a conversation's number, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


@query("op11_conversation_trie", f"""WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, sha256(CAST(length(r) AS VARCHAR) || ':' || r || x)) AS said FROM t GROUP BY c),
h AS (SELECT c, said, c - c % {SPAN} AS lender, CAST({_CRC} % {HEAD} AS BIGINT) AS h FROM o),
b AS (SELECT h.c, list_concat(coalesce(l.said[1:h.h], []), h.said[h.h + 1:]) AS said FROM h LEFT JOIN o l ON l.c = h.lender),
m AS (SELECT c, said, unnest(range(0, len(said) + 1)) AS d FROM b),
p AS (SELECT c, d, len(said) AS n, sha256(to_json(said[1:d])) AS k, CASE WHEN d > 0 THEN sha256(to_json(said[1:d - 1])) END AS above,
  CASE WHEN d > 0 THEN length(said[d].x) ELSE 0 END AS chars FROM m),
n AS (SELECT k, d, above, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved, max(n) = d AS leaf,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256 FROM p GROUP BY k, d, above),
s AS (SELECT p.k, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE n.leaf) AS n_leaves
  FROM n JOIN p ON p.c = n.c AND p.d <= n.d GROUP BY p.k),
k AS (SELECT above, count(*) AS n_children FROM n GROUP BY above)
SELECT n.c AS conv_id, n.d AS depth, u.c AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.k = n.k LEFT JOIN n u ON u.k = n.above LEFT JOIN k ON k.above = n.k""")
def op11_conversation_trie(spark, d):
    return prefix_trie(*rebuilt(turns_of(table(spark, d, "conversations"))))
