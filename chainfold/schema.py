"""Explicit schemas. Nothing is inferred: a drifting source must fail, not re-shape itself."""

from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DecimalType, IntegerType,
                               LongType, StringType, StructField, StructType)

UINT64 = DecimalType(20, 0)


def _struct(**fields) -> StructType:
    return StructType([StructField(name.rstrip("_"), kind) for name, kind in fields.items()])


_B, _L, _I, _S = BinaryType(), LongType(), IntegerType(), StringType()

STORAGE_CHANGE = _struct(address=_B, key=_B, old_value=_B, new_value=_B, ordinal=_L)
BALANCE_CHANGE = _struct(address=_B, old_value=_B, new_value=_B, reason=_I, ordinal=_L)
NONCE_CHANGE = _struct(address=_B, old_value=UINT64, new_value=UINT64, ordinal=_L)
CODE_CHANGE = _struct(address=_B, old_hash=_B, new_hash=_B, new_code=_B, ordinal=_L)
AUTHORIZATION = _struct(authority=_B, address=_B, nonce=UINT64, discarded=BooleanType())
CALL = _struct(index=_I, parent_index=_I, call_type=_I, address=_B, state_reverted=BooleanType(),
               suicide=BooleanType(), begin_ordinal=_L, end_ordinal=_L,
               storage_changes=ArrayType(STORAGE_CHANGE), balance_changes=ArrayType(BALANCE_CHANGE),
               nonce_changes=ArrayType(NONCE_CHANGE), code_changes=ArrayType(CODE_CHANGE))
TRANSACTION = _struct(hash=_B, index=_I, type=_I, status=_I, from_=_B, nonce=UINT64, end_ordinal=_L,
                      set_code_authorizations=ArrayType(AUTHORIZATION), calls=ArrayType(CALL))
HEADER = _struct(number=_L, parent_hash=_B, state_root=_B, coinbase=_B,
                 timestamp=_struct(seconds=_L, nanos=_I))
BLOCK = _struct(ver=_I, detail_level=_I, number=_L, hash=_B, header=HEADER,
                transaction_traces=ArrayType(TRANSACTION), system_calls=ArrayType(CALL),
                balance_changes=ArrayType(BALANCE_CHANGE), code_changes=ArrayType(CODE_CHANGE))

STORAGE_VALUE = _struct(address=_S, slot=_S, value=_S, ordinal=_L)
BALANCE_VALUE = _struct(address=_S, value=_S, ordinal=_L)
NONCE_VALUE = _struct(address=_S, value=UINT64, ordinal=_L)
CODE_VALUE = _struct(address=_S, hash=_S, code=_S, ordinal=_L)
LIFECYCLE_EFFECT = _struct(address=_S, kind=_S, ordinal=_L)
GROUPS = {"storage": STORAGE_VALUE, "balances": BALANCE_VALUE, "nonces": NONCE_VALUE,
          "codes": CODE_VALUE, "lifecycle": LIFECYCLE_EFFECT}
ENVELOPE = StructType(
    _struct(number=_L, hash=_S, parent_hash=_S, timestamp=_L, state_root=_S,
            producer_version=_I, accounts=_S, schema_version=_I).fields
    + [StructField(name, ArrayType(kind)) for name, kind in GROUPS.items()])
# Extra columns a replacing sink adds to each envelope row.
RETRY_COLUMNS = StructType([StructField("_version_", _L), StructField("_deleted_", BooleanType())])

CHECKPOINT_STORAGE = _struct(address=_S, slot=_S, value=_S)
CHECKPOINT_ACCOUNT = _struct(address=_S, exists=BooleanType(), nonce=UINT64, balance=_S,
                             code_hash=_S, code=_S, storage_root=_S, nonzero_slots=_L)
EXPORT_ACCOUNT_FIELDS = ["address", "exists", "nonce", "balance", "code_hash", "code",
                         "storage_root", "nonzero_slots"]
PROOF = StructType([
    StructField("address", _S), StructField("nonce", _S), StructField("balance", _S),
    StructField("storageHash", _S), StructField("codeHash", _S),
    StructField("accountProof", ArrayType(_S))])
HEADER_SUMMARY = _struct(number=_L, hash=_S, parent_hash=_S, state_root=_S, timestamp=_L)

LAG_SAMPLE = StructType([
    StructField("started_at_unix_ns", _L), StructField("rpc_finalized_block", _L),
    StructField("durable_block", _L), StructField("finalized_lag_blocks", _L),
    StructField("durable_block_age_seconds", StringType()),
    StructField("sample_duration_seconds", StringType()), StructField("error_type", _S)])
