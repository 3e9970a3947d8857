"""Numbers wider than DECIMAL(38): exact decimal text made over Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def bytes_to_decimal(column: pd.Series) -> pd.Series:
    """Big-endian unsigned bytes to decimal text; missing or empty bytes are zero."""
    return column.map(lambda raw: str(int.from_bytes(raw, "big")) if raw is not None else "0",
                      na_action=None)


def quantity_to_decimal(text: Column, bits: int = 256) -> Column:
    """Hex quantity to decimal text; NULL when malformed or wider than ``bits``."""

    @F.pandas_udf(StringType())
    def convert(column: pd.Series) -> pd.Series:
        def one(value):
            if value is None or not value.startswith("0x") or len(value) < 3:
                return None
            digits = value[2:]
            if any(c not in "0123456789abcdefABCDEF" for c in digits):
                return None
            number = int(digits, 16)
            return str(number) if number.bit_length() <= bits else None
        return column.map(one, na_action=None)

    return convert(text)
