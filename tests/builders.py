"""Small nested blocks for the rule tests."""

from chainfold import schema as S


def addr(byte):
    return bytes([byte]) * 20


def w(byte):
    return bytes([byte]) * 32


def storage(address, ordinal, old, new, key=None):
    return dict(address=addr(address), key=key if key is not None else w(1), old_value=old, new_value=new,
                ordinal=ordinal)


def balance(address, reason, ordinal, old, new):
    return dict(address=addr(address), old_value=old.to_bytes(8, "big"), new_value=new.to_bytes(8, "big"),
                reason=reason, ordinal=ordinal)


def nonce(address, ordinal, old, new=None):
    return dict(address=addr(address), old_value=old, new_value=old + 1 if new is None else new, ordinal=ordinal)


def code(address, ordinal, old=b"", new=w(9), body=b"\xef\x01\x00"):
    return dict(address=addr(address), old_hash=old, new_hash=new, new_code=body, ordinal=ordinal)


def call(**fields):
    base = dict(index=0, parent_index=0, call_type=1, address=b"", state_reverted=False, suicide=False,
                begin_ordinal=0, end_ordinal=0, storage_changes=[], balance_changes=[], nonce_changes=[],
                code_changes=[])
    return {**base, **fields}


def tx(**fields):
    base = dict(hash=w(7), index=0, type=0, status=1, nonce=0, end_ordinal=0, set_code_authorizations=[], calls=[])
    base["from"] = b""
    sender = fields.pop("sender", None)
    merged = {**base, **fields}
    if sender is not None:
        merged["from"] = addr(sender)
    return merged


def auth(byte, discarded=False, nonce=0):
    return dict(authority=addr(byte), address=addr(0xDD), nonce=nonce, discarded=discarded)


def block(number=100, **fields):
    seconds = fields.pop("seconds", 1000)
    base = dict(ver=5, detail_level=0, number=number, hash=w(2),
                header=dict(number=number, parent_hash=w(1), state_root=w(3), coinbase=addr(5),
                            timestamp=dict(seconds=seconds, nanos=0)),
                transaction_traces=[], system_calls=[], balance_changes=[], code_changes=[])
    return {**base, **fields}


def frame(spark, *blocks):
    from decimal import Decimal

    def fix(value, kind):
        name = kind.typeName()
        if value is None:
            return None
        if name == "struct":
            return tuple(fix(value.get(f.name), f.dataType) for f in kind.fields)
        if name == "array":
            return [fix(v, kind.elementType) for v in value]
        if name == "decimal":
            return Decimal(value)
        return value
    return spark.createDataFrame([fix(b, S.BLOCK) for b in blocks], S.BLOCK)
