"""Keccak-256 over whole Arrow batches: the permutation runs once per column of messages."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

# Fixed values of the published permutation.
ROUND_CONSTANTS = [
    0x0000000000000001, 0x0000000000008082, 0x800000000000808A, 0x8000000080008000,
    0x000000000000808B, 0x0000000080000001, 0x8000000080008081, 0x8000000000008009,
    0x000000000000008A, 0x0000000000000088, 0x0000000080008009, 0x000000008000000A,
    0x000000008000808B, 0x800000000000008B, 0x8000000000008089, 0x8000000000008003,
    0x8000000000008002, 0x8000000000000080, 0x000000000000800A, 0x800000008000000A,
    0x8000000080008081, 0x8000000000008080, 0x0000000080000001, 0x8000000080008008,
]
RATE = 136


def _rotation_offsets() -> np.ndarray:
    offsets = np.zeros((5, 5), dtype=np.uint64)
    x, y = 1, 0
    for step in range(24):
        offsets[x, y] = ((step + 1) * (step + 2) // 2) % 64
        x, y = y, (2 * x + 3 * y) % 5
    return offsets


_OFFSETS = _rotation_offsets()


def _rotate(lanes: np.ndarray, count: int) -> np.ndarray:
    if count == 0:
        return lanes
    return (lanes << np.uint64(count)) | (lanes >> np.uint64(64 - count))


def _permute(state: list) -> list:
    """``state[x][y]`` is one 64-bit lane of every message."""
    for constant in ROUND_CONSTANTS:
        parity = [state[x][0] ^ state[x][1] ^ state[x][2] ^ state[x][3] ^ state[x][4] for x in range(5)]
        mix = [parity[(x - 1) % 5] ^ _rotate(parity[(x + 1) % 5], 1) for x in range(5)]
        moved = [[None] * 5 for _ in range(5)]
        for x in range(5):
            for y in range(5):
                moved[y][(2 * x + 3 * y) % 5] = _rotate(state[x][y] ^ mix[x], int(_OFFSETS[x, y]))
        state = [[moved[x][y] ^ (~moved[(x + 1) % 5][y] & moved[(x + 2) % 5][y]) for y in range(5)]
                 for x in range(5)]
        state[0][0] = state[0][0] ^ np.uint64(constant)
    return state


def _hash_equal_blocks(messages: Sequence[bytes], blocks: int) -> list[bytes]:
    width = blocks * RATE
    padded = np.zeros((len(messages), width), dtype=np.uint8)
    lengths = np.fromiter((len(m) for m in messages), dtype=np.int64, count=len(messages))
    joined = np.frombuffer(b"".join(messages), dtype=np.uint8)
    padded[np.arange(width)[None, :] < lengths[:, None]] = joined
    padded[np.arange(len(messages)), lengths] ^= 0x01
    padded[:, width - 1] ^= 0x80
    lanes = padded.view("<u8").reshape(len(messages), blocks, RATE // 8)
    zero = np.zeros(len(messages), dtype=np.uint64)
    state = [[zero for _ in range(5)] for _ in range(5)]
    for block in range(blocks):
        for lane in range(RATE // 8):
            x, y = lane % 5, lane // 5
            state[x][y] = state[x][y] ^ lanes[:, block, lane]
        state = _permute(state)
    digest = np.stack([state[x][0] for x in range(4)], axis=1).astype("<u8").tobytes()
    return [digest[i:i + 32] for i in range(0, len(digest), 32)]


def keccak_many(messages: Sequence[bytes]) -> list[bytes]:
    """Digests in input order; messages of equal block count are hashed together."""
    by_blocks: dict[int, list[int]] = {}
    for index, message in enumerate(messages):
        by_blocks.setdefault(len(message) // RATE + 1, []).append(index)
    result: list[bytes] = [b""] * len(messages)
    for blocks, indexes in by_blocks.items():
        for start in range(0, len(indexes), 8192):
            part = indexes[start:start + 8192]
            for index, digest in zip(part, _hash_equal_blocks([messages[i] for i in part], blocks)):
                result[index] = digest
    return result


@F.pandas_udf(BinaryType())
def keccak256(column: pd.Series) -> pd.Series:
    present = column.notna()
    digests = iter(keccak_many([bytes(v) for v in column[present]]))
    return pd.Series([next(digests) if ok else None for ok in present], index=column.index, dtype=object)
