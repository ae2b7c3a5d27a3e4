"""Surrogate keys.

The key is the hex MD5 of the key columns cast to string, NULLs replaced by a
placeholder and columns joined by '-'; the definition of the public dbt-utils
``generate_surrogate_key`` macro, so keys equal the ones the warehouse made.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key definition.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols) -> Column:
    parts = []
    for i, c in enumerate(cols):
        col = F.col(c) if isinstance(c, str) else c
        if i:
            parts.append(F.lit(SEPARATOR))
        parts.append(F.coalesce(col.cast("string"), F.lit(NULL_PLACEHOLDER)))
    return F.md5(F.concat(*parts))


def packed(col: Column) -> Column:
    """A hexadecimal key as its bytes, half as long in a shuffle; any other text as it is.  A leading byte tells which."""
    raw = F.unhex(col)
    return F.when(F.lower(F.hex(raw)) == col, F.concat(F.lit(b"\0"), raw)).otherwise(F.concat(F.lit(b"\1"), col.cast("binary")))


def unpacked(col: Column) -> Column:
    rest = F.substring(col, 2, 0x7FFFFFFF)
    return F.when(F.substring(col, 1, 1) == F.lit(b"\0"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
