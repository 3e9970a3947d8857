"""Audits over tables of account proofs and block headers.

Proofs and headers are per-row codecs with recursion and 256-bit integers, so they run in
``mapInPandas``; every row is independent and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chainfold.functions import scalars as X
from chainfold.functions.keccak import keccak256, keccak_many
from chainfold.operators.trie import compact_path, rlp_bytes, rlp_list

# Header fields in encoding order with byte length or integer width in bits.
HEADER_FIELDS = [
    ("parentHash", 32, None), ("sha3Uncles", 32, None), ("miner", 20, None), ("stateRoot", 32, None),
    ("transactionsRoot", 32, None), ("receiptsRoot", 32, None), ("logsBloom", 256, None),
    ("difficulty", None, 256), ("number", None, 64), ("gasLimit", None, 64), ("gasUsed", None, 64),
    ("timestamp", None, 64), ("extraData", None, None), ("mixHash", 32, None), ("nonce", 8, None),
    ("baseFeePerGas", None, 256), ("withdrawalsRoot", 32, None), ("blobGasUsed", None, 64),
    ("excessBlobGas", None, 64), ("parentBeaconBlockRoot", 32, None), ("requestsHash", 32, None),
    ("balHash", 32, None), ("slotNumber", None, 64),
]
REQUIRED_FIELDS = 15
MAX_HEADER_BYTES = 104_448

PROVEN = ("address string, exists boolean, nonce decimal(20,0), balance string, storage_root string, "
          "code_hash string, error string")


class Malformed(ValueError):
    """A row that breaks an encoding rule; its text becomes the row's error."""


def _need(ok: bool, text: str) -> None:
    if not ok:
        raise Malformed(text)


def _bytes(text, size: int | None = None) -> bytes:
    _need(isinstance(text, str) and text.startswith("0x"), "expected 0x-prefixed hex")
    try:
        raw = bytes.fromhex(text[2:])
    except ValueError:
        raise Malformed("invalid hex") from None
    _need(len(text) == 2 + 2 * len(raw), "invalid hex")
    _need(size is None or len(raw) == size, f"expected {size} bytes")
    return raw


def _quantity(text, bits: int) -> int:
    _need(isinstance(text, str) and text.startswith("0x") and len(text) > 2
          and all(c in "0123456789abcdefABCDEF" for c in text[2:]), "invalid quantity")
    number = int(text[2:], 16)
    _need(number.bit_length() <= bits, f"quantity exceeds uint{bits}")
    return number


def _integer(number: int) -> bytes:
    return rlp_bytes(number.to_bytes((number.bit_length() + 7) // 8, "big"))


def decode_item(data: bytes, at: int) -> tuple[bool, bytes, int]:
    """One item of canonical RLP: (is list, payload, next offset)."""
    _need(at < len(data), "truncated encoding")
    first = data[at]
    if first < 0x80:
        return False, data[at:at + 1], at + 1
    is_list = first >= 0xC0
    short = first - (0xC0 if is_list else 0x80)
    if short < 56:
        start, size = at + 1, short
    else:
        width = short - 55
        raw = data[at + 1:at + 1 + width]
        _need(len(raw) == width and raw[0] != 0, "non-canonical length")
        start, size = at + 1 + width, int.from_bytes(raw, "big")
        _need(size >= 56, "non-canonical length")
    payload = data[start:start + size]
    _need(len(payload) == size, "truncated encoding")
    _need(is_list or size != 1 or payload[0] >= 0x80, "non-canonical byte")
    return is_list, payload, start + size


def decode_list(payload: bytes) -> list[tuple[bool, bytes, bytes]]:
    """Items as (is list, payload, full encoding)."""
    items, at = [], 0
    while at < len(payload):
        is_list, body, end = decode_item(payload, at)
        items.append((is_list, body, payload[at:end]))
        at = end
    return items


def walk_proof(root: bytes, key: str, nodes: list[bytes]) -> bytes | None:
    """Value stored under the nibble key, or None when absence is proven. Unused nodes are an error."""
    digests = keccak_many(nodes)
    expected: bytes | None = b"\xa0" + root
    used, depth = 0, 0
    if not nodes:
        _need(root.hex() == X.EMPTY_ROOT[2:], "incomplete proof")
        return None
    while True:
        if expected[:1] == b"\xa0" and len(expected) == 33:
            _need(used < len(nodes) and digests[used] == expected[1:], "proof node does not match its parent")
            encoded = nodes[used]
            used += 1
        else:
            encoded = expected                     # short nodes sit inside their parent
            if used < len(nodes) and nodes[used] == encoded:
                used += 1
        if encoded == b"\x80" and used == len(nodes):
            return None                            # the empty trie
        is_list, payload, end = decode_item(encoded, 0)
        _need(is_list and end == len(encoded), "proof node is not a list")
        items = decode_list(payload)
        if len(items) == 17:
            _need(depth < 64, "proof runs past its key")
            following = items[int(key[depth], 16)]
            depth += 1
            if not following[0] and following[1] == b"":
                _need(used == len(nodes), "unused proof nodes")
                return None
        else:
            _need(len(items) == 2 and not items[0][0] and items[0][1], "unknown proof node")
            flag = items[0][1][0] >> 4
            path = items[0][1].hex()[1 if flag % 2 else 2:]
            _need(flag < 4 and items[0][1] == compact_path(path, flag >= 2), "malformed node path")
            same = key[depth:depth + len(path)] == path
            if flag >= 2:
                _need(used == len(nodes), "unused proof nodes")
                return items[1][1] if same and depth + len(path) == 64 else None
            if not same:
                _need(used == len(nodes), "unused proof nodes")
                return None
            depth += len(path)
            following = items[1]
        expected = following[2]


def _audit_proof(row) -> tuple:
    address = _bytes(row.address, 20)
    if row.proof_address is not None:
        _need(_bytes(row.proof_address, 20) == address, "proof names another account")
    nonce, balance = _quantity(row.nonce, 64), _quantity(row.balance, 256)
    storage, code = _bytes(row.storageHash, 32), _bytes(row.codeHash, 32)
    nodes = [_bytes(n) for n in row.accountProof]
    key = keccak_many([address])[0].hex()
    value = walk_proof(_bytes(row.state_root, 32), key, nodes)
    claim = rlp_list([_integer(nonce), _integer(balance), rlp_bytes(storage), rlp_bytes(code)])
    if value is None:
        _need(nonce == 0 and balance == 0 and "0x" + storage.hex() == X.EMPTY_ROOT
              and "0x" + code.hex() == X.EMPTY_CODE_HASH, "account metadata does not match proven absence")
    else:
        _need(value == claim, "invalid or incomplete account proof")
    return ("0x" + address.hex(), value is not None, nonce, str(balance), "0x" + storage.hex(),
            "0x" + code.hex(), None)


def audit_proofs(proofs: DataFrame, state_root: str) -> DataFrame:
    """Check proofs(address, proof_address, nonce, balance, storageHash, codeHash, accountProof).

    A row that fails keeps its address and an error; its other columns are NULL.
    """
    from decimal import Decimal

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for row in frame.itertuples(index=False):
                try:
                    out.append(_audit_proof(row))
                except Malformed as error:
                    out.append((row.address, None, None, None, None, None, str(error)))
            result = pd.DataFrame(out, columns=["address", "exists", "nonce", "balance", "storage_root",
                                                "code_hash", "error"], dtype=object)
            result["nonce"] = result["nonce"].map(lambda n: None if n is None else Decimal(n))
            yield result

    with_root = proofs if "state_root" in proofs.columns else proofs.withColumn("state_root", F.lit(state_root))
    return with_root.mapInPandas(run, PROVEN)


# ---------------------------------------------------------------- headers

def _encode_header(row: dict) -> bytes:
    present = [i for i, (name, _, _) in enumerate(HEADER_FIELDS)
               if i < REQUIRED_FIELDS or row.get(name) is not None]
    out = []
    for i, (name, size, bits) in enumerate(HEADER_FIELDS[:present[-1] + 1]):
        value = row.get(name)
        if value is None:
            _need(i >= REQUIRED_FIELDS, f"header missing {name}")
            out.append(rlp_bytes(b""))
        elif bits is not None:
            out.append(_integer(_quantity(value, bits)))
        else:
            out.append(rlp_bytes(_bytes(value, size)))
    encoded = rlp_list(out)
    _need(keccak_many([encoded])[0] == _bytes(row.get("hash"), 32), "encoded header does not match its block hash")
    return encoded


def encode_headers(headers: DataFrame) -> DataFrame:
    """RLP of JSON headers (the named fields plus hash), checked against their own hash."""
    names = [n for n, _, _ in HEADER_FIELDS]
    have = [F.col(n) if n in headers.columns else F.lit(None).cast("string").alias(n) for n in names]

    def run(batches):
        for frame in batches:
            out = []
            for row in frame.to_dict("records"):
                clean = {k: (v if isinstance(v, str) else None) for k, v in row.items()}
                try:
                    out.append((clean["hash"], "0x" + _encode_header(clean).hex(), None))
                except Malformed as error:
                    out.append((clean["hash"], None, str(error)))
            yield pd.DataFrame(out, columns=["hash", "header_rlp", "error"], dtype=object)

    return headers.select("hash", *have).mapInPandas(run, "hash string, header_rlp string, error string")


def _audit_header(row) -> None:
    encoded = _bytes(row.header_rlp)
    _need(len(encoded) <= MAX_HEADER_BYTES, "oversized block header")
    is_list, payload, end = decode_item(encoded, 0)
    _need(is_list, "header is not a list")
    _need(end == len(encoded), "trailing bytes after header")
    items = decode_list(payload)
    _need(all(not nested for nested, _, _ in items), "nested list in header")
    fields = [body for _, body, _ in items]
    _need(REQUIRED_FIELDS <= len(fields) <= len(HEADER_FIELDS), "unsupported header field count")
    for i, (value, (name, size, bits)) in enumerate(zip(fields, HEADER_FIELDS)):
        if bits is not None:
            _need(value[:1] != b"\0" and len(value) <= bits // 8, f"invalid header integer {name}")
        if size is not None:
            _need(len(value) == size or (i >= REQUIRED_FIELDS and value == b""), f"invalid length of {name}")
    digest = keccak_many([encoded])[0]
    _need(digest == _bytes(row.hash, 32), "encoded header differs from block hash")
    if row.expected_hash is not None:
        _need(digest == _bytes(row.expected_hash, 32), "encoded header differs from expected hash")
    _need(fields[0] == _bytes(row.parent_hash, 32) and fields[3] == _bytes(row.state_root, 32)
          and int.from_bytes(fields[8], "big") == row.number
          and int.from_bytes(fields[11], "big") == row.timestamp, "summary differs from encoded header")


def audit_headers(headers: DataFrame) -> DataFrame:
    """Check headers(number, hash, parent_hash, state_root, timestamp, header_rlp[, expected_hash])."""
    if "expected_hash" not in headers.columns:
        headers = headers.withColumn("expected_hash", F.lit(None).cast("string"))

    def run(batches):
        for frame in batches:
            out = []
            for row in frame.itertuples(index=False):
                try:
                    _audit_header(row)
                    out.append((row.number, row.hash, None))
                except Malformed as error:
                    out.append((row.number, row.hash, str(error)))
            yield pd.DataFrame({"number": [o[0] for o in out], "hash": [o[1] for o in out],
                                "error": pd.Series([o[2] for o in out], dtype=object)})

    return headers.select("number", "hash", "parent_hash", "state_root", "timestamp", "header_rlp",
                          "expected_hash").mapInPandas(run, "number bigint, hash string, error string")


# ---------------------------------------------------------------- metadata

def metadata_mismatches(accounts: DataFrame, proven: DataFrame) -> DataFrame:
    """Compare nonce, balance, code hash and keccak(code) with proven accounts, field by field."""
    a, p = accounts.alias("a"), proven.alias("p")
    code_hash = X.hex_text(keccak256(F.unhex(F.substring(F.col("a.code"), 3, 1 << 30))))
    checks = [
        ("nonce", F.col("a.nonce").eqNullSafe(F.col("p.nonce"))),
        ("balance", X.is_exact_decimal("a.balance") & F.col("a.balance").eqNullSafe(F.col("p.balance"))),
        ("code_hash", F.lower("a.code_hash").eqNullSafe(F.lower("p.code_hash"))),
        ("code", X.is_hex_bytes("a.code") & code_hash.eqNullSafe(F.lower("p.code_hash"))),
    ]
    wrong = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks]),
                     lambda n: n.isNotNull())
    return (a.join(p, "address", "inner").select("address", F.explode(wrong).alias("field")))
