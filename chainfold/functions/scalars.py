"""Column functions for words, addresses, quantities and tokens. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
ZERO_WORD = "0x0000000000000000000000000000000000000000000000000000000000000000"
EMPTY_CODE_HASH = "0xc5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
EMPTY_ROOT = "0x56e81f171bcc55a6ff8345e692c0f86e5b48e01b996cadc001622fb5e363b421"
SCOPES = {1: "tx", 2: "tx_failed_persistent", 3: "tx_7702", 4: "system_call", 5: "block"}
EXACT_DECIMAL = "^(0|[1-9][0-9]*)$"
MAX_UINT64 = "18446744073709551615"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hex_text(binary: Column | str) -> Column:
    """Bytes to lower-case ``0x`` text; missing bytes give ``0x``."""
    return F.concat(F.lit("0x"), F.lower(F.hex(F.coalesce(_col(binary), F.lit(b"")))))


def bytea_text(binary: Column | str) -> Column:
    return F.concat(F.lit("\\x"), F.lower(F.hex(_col(binary))))


def word(binary: Column | str) -> Column:
    """Bytes to a 32-byte word, zeros put in front. Longer input is an error."""
    raw = F.coalesce(_col(binary), F.lit(b""))
    padded = F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(raw)), 64, "0"))
    return F.when(F.length(raw) <= 32, padded).otherwise(
        F.raise_error(F.lit("storage word exceeds 32 bytes")).cast("string"))


def number_word(number: Column | str, digits: int = 64) -> Column:
    """A non-negative BIGINT as fixed-width hex text."""
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(_col(number).cast("bigint"))), digits, "0"))


def significant(binary: Column | str) -> Column:
    """Hex digits without leading zeros: equal exactly when the two numbers are equal."""
    return F.ltrim(F.hex(F.coalesce(_col(binary), F.lit(b""))), F.lit("0"))


def is_fixed_hex(text: Column | str, size: int) -> Column:
    """True for ``0x`` text of exactly ``size`` bytes (NULL counts as wrong)."""
    return F.coalesce(_col(text).rlike("^0x[0-9a-fA-F]{%d}$" % (2 * size)), F.lit(False))


def is_hex_bytes(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike("^0x([0-9a-fA-F]{2})*$"), F.lit(False))


def to_bytes(text: Column | str) -> Column:
    """``0x`` text to bytes; malformed text is an error."""
    return F.when(is_hex_bytes(text), F.unhex(F.substring(_col(text), 3, 1 << 30))).otherwise(
        F.raise_error(F.concat(F.lit("invalid hex: "), F.coalesce(_col(text), F.lit("NULL")))).cast("binary"))


def canonical_address(text: Column | str) -> Column:
    """Lower-case 20-byte address, or an error."""
    return F.when(is_fixed_hex(text, 20), F.lower(_col(text))).otherwise(
        F.raise_error(F.concat(F.lit("invalid address: "), F.coalesce(_col(text), F.lit("NULL")))).cast("string"))


def quantity_u64(text: Column | str) -> Column:
    """Hex quantity of at most 64 bits to DECIMAL(20,0); NULL when malformed or wider."""
    digits = F.ltrim(F.substring(_col(text), 3, 1 << 30), F.lit("0"))
    valid = _col(text).rlike("^0x[0-9a-fA-F]+$") & (F.length(digits) <= 16)
    return F.when(valid & (digits == ""), F.lit(0).cast("decimal(20,0)")).when(
        valid, F.conv(digits, 16, 10).cast("decimal(20,0)"))


def is_exact_decimal(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike(EXACT_DECIMAL), F.lit(False))


def is_exact_uint64(text: Column | str) -> Column:
    """Exact decimal text that fits 64 unsigned bits, compared by length and then by digits."""
    value = _col(text)
    return is_exact_decimal(value) & (
        (F.length(value) < 20) | ((F.length(value) == 20) & (value <= F.lit(MAX_UINT64))))


def decimal_order(text: Column | str) -> Column:
    """Sort key for exact decimal text of any length."""
    return F.struct(F.length(_col(text)), _col(text))


def position(number: Column | str = "number", ordinal: Column | str = "ordinal") -> Column:
    """Chain position; structs compare field by field."""
    return F.struct(_col(number).cast("bigint").alias("number"),
                    _col(ordinal).cast("bigint").alias("ordinal"))


def scope_name(code: Column | str) -> Column:
    name = F.lit("unspecified")
    for key, text in SCOPES.items():
        name = F.when(_col(code) == key, text).otherwise(name)
    return name


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys; NULL fields stay as null."""
    ordered = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return F.to_json(ordered, {"ignoreNullFields": "false"})


def canonical_document(text: Column | str) -> Column:
    """Compact JSON of any document with the keys of every object sorted, at every depth; malformed text is an error.

    A VARIANT keeps the fields of an object in key order, so parsing and printing is all there is to do. Equal documents
    give equal text whatever the order of their keys and their white space; arrays keep their order.
    """
    return F.to_json(F.parse_json(_col(text)))


def document_value(text: Column | str, path: str, kind: str) -> Column:
    """A typed value out of any JSON document; NULL where the document has none or is malformed."""
    return F.try_variant_get(F.try_parse_json(_col(text)), path, kind)


def url_token(text: Column | str) -> Column:
    return F.translate(F.base64(F.encode(_col(text), "utf-8")), "+/\r\n", "-_")


def url_token_text(token: Column | str) -> Column:
    return F.decode(F.unbase64(F.translate(_col(token), "-_", "+/")), "utf-8")


def day_partition(seconds: Column | str) -> Column:
    """Day of a unix time, the same in every session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(_col(seconds) / 86_400).cast("int"))


def month_partition(stamp: Column | str) -> Column:
    return F.date_format(_col(stamp), "yyyyMM").cast("int")


def keys_with_prefix(mapping: Column | str, prefix: str) -> Column:
    return F.map_filter(_col(mapping), lambda key, _: key.startswith(prefix))


def manifest_fields(text: Column | str, schema: str) -> Column:
    """Typed fields of a JSON manifest; malformed text gives NULL fields."""
    return F.from_json(_col(text), schema)
