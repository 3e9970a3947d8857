"""A plain recursive trie, used to make proofs and to check the distributed one."""

from chainfold.functions.keccak import keccak_many
from chainfold.operators.trie import compact_path, references, rlp_bytes, rlp_list

EMPTY = "0x56e81f171bcc55a6ff8345e692c0f86e5b48e01b996cadc001622fb5e363b421"
NO_CODE = "0xc5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
PROOFS = ("address string, proof_address string, nonce string, balance string, storageHash string, codeHash string, "
          "accountProof array<string>, code string")


def keccak(raw):
    return keccak_many([raw])[0]


def integer(n):
    return rlp_bytes(n.to_bytes((n.bit_length() + 7) // 8, "big"))


def node(items, depth, trail=None, key=None):
    """Encoding of sorted (nibble key, value) items; nodes on the way to ``key`` go to ``trail``."""
    if len(items) == 1:
        path, value = items[0]
        encoded = rlp_list([rlp_bytes(compact_path(path[depth:], True)), rlp_bytes(value)])
        if trail is not None:
            trail.append(encoded)
        return encoded
    low, high = items[0][0], items[-1][0]
    split = depth
    while low[split] == high[split]:
        split += 1
    if split > depth:
        own = [] if trail is not None and key[depth:split] == low[depth:split] else None
        inner = node(items, split, own, key)
        encoded = rlp_list([rlp_bytes(compact_path(low[depth:split], False)), references([inner])[0]])
        if trail is not None:
            trail.append(encoded)
            trail.extend(own or [])
        return encoded
    slots, below = [b"\x80"] * 17, []
    for digit in "0123456789abcdef":
        part = [i for i in items if i[0][depth] == digit]
        if part:
            own = [] if trail is not None and key[depth] == digit else None
            slots[int(digit, 16)] = references([node(part, depth + 1, own, key)])[0]
            below.extend(own or [])
    encoded = rlp_list(slots)
    if trail is not None:
        trail.append(encoded)
        trail.extend(below)
    return encoded


def storage_root(slots):
    """Root of {slot text: value text}."""
    items = sorted((keccak(bytes.fromhex(s[2:])).hex(), integer(int(v, 16))) for s, v in slots.items() if int(v, 16))
    return "0x" + keccak(node(items, 0)).hex() if items else EMPTY


def bundle(number, block_hash, accounts, parent_hash="0x" + "11" * 32, timestamp=1000):
    """Header and proof rows of {address: (nonce, balance, code, slots)}."""
    claims, items = {}, []
    for address, (nonce, balance, code, slots) in accounts.items():
        code_hash = "0x" + keccak(bytes.fromhex(code[2:])).hex()
        root = storage_root(slots)
        claims[address] = (nonce, balance, root, code_hash, code)
        if (nonce, balance, root, code_hash) != (0, 0, EMPTY, NO_CODE):
            items.append((keccak(bytes.fromhex(address[2:])).hex(), rlp_list(
                [integer(nonce), integer(balance), rlp_bytes(bytes.fromhex(root[2:])),
                 rlp_bytes(bytes.fromhex(code_hash[2:]))])))
    items.sort()
    state_root = "0x" + keccak(node(items, 0)).hex()
    rows = []
    for address, (nonce, balance, root, code_hash, code) in claims.items():
        trail = []
        node(items, 0, trail, keccak(bytes.fromhex(address[2:])).hex())
        # Nodes shorter than a hash sit inside their parent and are not listed.
        proof = ["0x" + n.hex() for i, n in enumerate(trail) if i == 0 or len(n) >= 32]
        rows.append((address, address, hex(nonce), hex(balance), root, code_hash, proof, code))
    header = {"number": number, "hash": block_hash, "parent_hash": parent_hash, "state_root": state_root,
              "timestamp": timestamp}
    return header, rows


def encoded_header(header):
    """RLP of a header with the summary's fields; sets the header's hash."""
    raw = lambda text: rlp_bytes(bytes.fromhex(text[2:]))
    fill = lambda n: rlp_bytes(b"\x07" * n)
    fields = [raw(header["parent_hash"]), fill(32), fill(20), raw(header["state_root"]), fill(32), fill(32), fill(256),
              integer(2), integer(header["number"]), integer(30), integer(21), integer(header["timestamp"]),
              rlp_bytes(b"x"), fill(32), fill(8)]
    encoded = rlp_list(fields)
    header["hash"] = "0x" + keccak(encoded).hex()
    return "0x" + encoded.hex()
