"""Storage roots of all accounts at once.

Slots are hashed, then spread by (account, first nibbles of the hash). How many nibbles is chosen per
account from its slot count, so an account with most of the table is split into many equal buckets
while a small one stays whole. Each bucket folds to one *unfinished* node; unfinished nodes of an
account are folded again, at most 65536 at a time, until one is left. The root does not depend on the
split.

A node is (path, branch, body): ``path`` is the nibble text above it that is still open, ``body`` the
encoded value of a leaf or the encoded node of a branch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chainfold.functions import scalars as X
from chainfold.functions.keccak import keccak256, keccak_many

BUCKET_SLOTS = 4_096
MAX_DEPTH = 7                 # 16^7 buckets: about a trillion slots in one account
FOLD_LEVELS = (4, 0)          # a fold joins at most 16^4 nodes

NODE = "address string, depth int, prefix string, path string, branch boolean, body binary, slots bigint"


# ---------------------------------------------------------------- encodings

def rlp_bytes(raw: bytes) -> bytes:
    if len(raw) == 1 and raw[0] < 0x80:
        return raw
    return _headed(0x80, raw)


def rlp_list(encoded: list[bytes]) -> bytes:
    return _headed(0xC0, b"".join(encoded))


def _headed(base: int, payload: bytes) -> bytes:
    size = len(payload)
    if size < 56:
        return bytes([base + size]) + payload
    width = (size.bit_length() + 7) // 8
    return bytes([base + 55 + width]) + size.to_bytes(width, "big") + payload


def compact_path(nibbles: str, leaf: bool) -> bytes:
    flag = (2 if leaf else 0) + len(nibbles) % 2
    return bytes.fromhex(f"{flag:x}{nibbles}" if len(nibbles) % 2 else f"{flag:x}0{nibbles}")


def references(encoded: list[bytes]) -> list[bytes]:
    """How a parent names its children: short nodes inline, others by hash (one batch)."""
    long = [i for i, node in enumerate(encoded) if len(node) >= 32]
    result = list(encoded)
    for i, digest in zip(long, keccak_many([encoded[i] for i in long])):
        result[i] = b"\xa0" + digest
    return result


def close_nodes(nodes: list[tuple[str, bool, bytes]]) -> list[bytes]:
    """Encode nodes whose open path is now final."""
    extended = [i for i, (path, branch, _) in enumerate(nodes) if branch and path]
    inner = dict(zip(extended, references([nodes[i][2] for i in extended])))
    result = []
    for i, (path, branch, body) in enumerate(nodes):
        if not branch:
            result.append(rlp_list([rlp_bytes(compact_path(path, True)), rlp_bytes(body)]))
        elif path:
            result.append(rlp_list([rlp_bytes(compact_path(path, False)), inner[i]]))
        else:
            result.append(body)
    return result


# ---------------------------------------------------------------- folding

def fold(groups: list[list[tuple[str, bool, bytes]]]) -> list[tuple[str, bool, bytes]]:
    """Fold each group of sorted, distinct open nodes into one open node.

    All groups advance together, one nibble level at a time from the deepest shared prefix, so every
    level is one batch of hashes.
    """
    work = [list(g) for g in groups]
    shared = [[_common(a[0], b[0]) for a, b in zip(g, g[1:])] for g in work]
    full = [[n[0] for n in g] for g in work]    # first key of each node: names its path from the top
    level = max((d for s in shared for d in s), default=-1)
    while level >= 0:
        runs = []                               # (group, first, last) joined at this level
        for g, depths in enumerate(shared):
            start = 0
            while start < len(depths):
                if depths[start] != level:
                    start += 1
                    continue
                stop = start
                while stop < len(depths) and depths[stop] == level:
                    stop += 1
                runs.append((g, start, stop))
                start = stop
        children = [(full[g][i], work[g][i]) for g, a, b in runs for i in range(a, b + 1)]
        closed = references(close_nodes([_below(key, node, level + 1) for key, node in children]))
        at = 0
        joined: dict[int, list[tuple[int, int, bytes]]] = {}
        for g, a, b in runs:
            slots = [b"\x80"] * 17
            for i in range(a, b + 1):
                slots[int(full[g][i][level], 16)] = closed[at]
                at += 1
            joined.setdefault(g, []).append((a, b, rlp_list(slots)))
        for g, parts in joined.items():
            for a, b, body in reversed(parts):
                work[g][a:b + 1] = [(full[g][a][:level], True, body)]
                full[g][a:b + 1] = [full[g][a]]
                shared[g][a:b] = []
        level = max((d for s in shared for d in s), default=-1)
    return [g[0] for g in work]


def _common(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    raise ValueError("two values for one slot")


def _below(key: str, node: tuple[str, bool, bytes], depth: int) -> tuple[str, bool, bytes]:
    path, branch, body = node
    return path[depth:], branch, body


# ---------------------------------------------------------------- Spark stages

def _grouped(batches: Iterator[pd.DataFrame], depth_of) -> Iterator[list[tuple]]:
    """Split sorted batches into whole groups, holding back only the last open one."""
    rest: list[tuple] = []
    for frame in batches:
        rows = rest + list(frame.itertuples(index=False, name=None))
        if not rows:
            continue
        last = depth_of(rows[-1])
        edge = len(rows)
        while edge > 0 and depth_of(rows[edge - 1]) == last:
            edge -= 1
        if edge:
            yield rows[:edge]
        rest = rows[edge:]
    if rest:
        yield rest


def _fold_rows(rows: list[tuple], key) -> Iterator[tuple]:
    """Rows are sorted by group and path; yields (first row, folded node, slot count) per group."""
    groups, heads, counts = [], [], []
    for row in rows:
        name = key(row)
        if not heads or key(heads[-1]) != name:
            heads.append(row)
            groups.append([])
            counts.append(0)
        groups[-1].append((row[3], bool(row[4]), bytes(row[5])))
        counts[-1] += int(row[6])
    yield from zip(heads, fold(groups), counts)


def _bucket(row: tuple) -> tuple:
    return row[0], row[2]


def _fold_stage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fold the nodes of every (account, prefix) bucket into one open node."""
    for rows in _grouped(batches, _bucket):
        out = [(*head[:3], *node, slots) for head, node, slots in _fold_rows(rows, _bucket)]
        yield pd.DataFrame(out, columns=["address", "depth", "prefix", "path", "branch", "body", "slots"])


def hashed_slots(state: DataFrame) -> DataFrame:
    """Hash key and trimmed value per slot; malformed words and zero values are an error."""
    ok = X.is_fixed_hex("slot", 32) & X.is_fixed_hex("value", 32) & (F.col("value") != X.ZERO_WORD)
    checked = F.when(ok, F.unhex(F.substring("slot", 3, 64))).otherwise(F.raise_error(F.concat(
        F.lit("complete storage must hold nonzero 32-byte words: "), F.col("address"), F.lit(" "),
        F.coalesce("slot", F.lit("NULL")))).cast("binary"))
    digits = F.ltrim(F.lower(F.substring("value", 3, 64)), F.lit("0"))
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    return state.select("address", F.lower(F.hex(keccak256(checked))).alias("key"), F.unhex(even).alias("v"))


def _rlp_value(value):
    """RLP of a short byte string; values here have at most 32 bytes."""
    first = F.hex(F.substring(value, 1, 1))
    small = (F.length(value) == 1) & (first < F.lit("80"))
    head = F.unhex(F.hex(F.length(value) + 128))
    return F.when(small, value).otherwise(F.concat(head, value))


def storage_roots(state: DataFrame, bucket_slots: int = BUCKET_SLOTS) -> DataFrame:
    """Root and slot count of every account in state(address, slot, value)."""
    counts = state.groupBy("address").agg(F.count("*").alias("n"))
    power = F.ceil(F.log(16.0, F.greatest(F.col("n") / F.lit(float(bucket_slots)), F.lit(1.0))))
    depths = counts.select("address", F.when(power > MAX_DEPTH, F.raise_error(F.lit(
        "an account has more slots than the deepest buckets hold"))).otherwise(power).cast("int").alias("depth"))
    leaves = (hashed_slots(state).join(depths, "address")
              .withColumn("prefix", F.expr("substring(key, 1, depth)"))
              .select("address", "depth", "prefix", F.expr("substring(key, depth + 1, 64)").alias("path"),
                      F.lit(False).alias("branch"), _rlp_value(F.col("v")).alias("body"),
                      F.lit(1).cast("bigint").alias("slots")))
    nodes = (leaves.repartition("address", "prefix").sortWithinPartitions("address", "prefix", "path")
             .mapInPandas(_fold_stage, NODE))
    for level in FOLD_LEVELS:
        # Re-open the nibbles below the new level, so that the fold sees them again.
        opened = nodes.select(
            "address", F.least("depth", F.lit(level)).alias("depth"),
            F.substring("prefix", 1, level).alias("prefix") if level else F.lit("").alias("prefix"),
            F.concat(F.expr(f"substring(prefix, {level} + 1, 64)"), "path").alias("path"),
            "branch", "body", "slots")
        nodes = (opened.repartition("address", "prefix").sortWithinPartitions("address", "prefix", "path")
                 .mapInPandas(_fold_stage, NODE))
    return nodes.mapInPandas(_close_roots, "address string, storage_root string, nonzero_slots bigint")


def _close_roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        nodes = [(p, bool(b), bytes(x)) for p, b, x in zip(frame.path, frame.branch, frame.body)]
        roots = keccak_many(close_nodes(nodes))
        yield pd.DataFrame({"address": frame.address, "storage_root": ["0x" + r.hex() for r in roots],
                            "nonzero_slots": frame.slots})


def account_roots(accounts: DataFrame, state: DataFrame) -> DataFrame:
    """Roots for all listed accounts; one without slots has the fixed empty root."""
    return accounts.select("address").join(storage_roots(state), "address", "left").select(
        "address", F.coalesce("storage_root", F.lit(X.EMPTY_ROOT)).alias("storage_root"),
        F.coalesce("nonzero_slots", F.lit(0)).alias("nonzero_slots"))
