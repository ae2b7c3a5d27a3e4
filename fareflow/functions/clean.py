"""Cleaning expressions used by staging.

All are Column -> Column and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace stripped by TRIM: the warehouse strips all whitespace, Spark's
# plain trim only spaces, so the set is stated explicitly.
WHITESPACE = " \t\r\n"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """TRIM with the warehouse's whitespace set."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def clean_enum(c) -> Column:
    """Normalise enum text: lower(trim(c))."""
    return F.lower(trim_ws(c))


def whitelist(c, values: Iterable[str], default: str | None = None) -> Column:
    """Keep a normalised value only if it is one of ``values``.

    Anything else becomes ``default`` (NULL when not given).  C3/C4.
    """
    norm = clean_enum(c)
    expr = F.when(norm.isin(list(values)), norm)
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def blank_default(c, default: str, upper: bool = True) -> Column:
    """NULL or blank -> ``default``; else trimmed (and upper-cased).  C5."""
    raw = _col(c)
    value = F.upper(trim_ws(raw)) if upper else trim_ws(raw)
    return F.when(raw.isNull() | (trim_ws(raw) == F.lit("")), F.lit(default)).otherwise(value)


def clamp(c, lo: float, hi: float) -> Column:
    """Clamp into [lo, hi]; NULL stays NULL (``least``/``greatest`` would not).  C6."""
    v = _col(c)
    return (F.when(v.between(lo, hi), v)
            .when(v > hi, F.lit(float(hi)))
            .when(v < lo, F.lit(float(lo))))


def floor_zero(c, null_to=None) -> Column:
    """Negative -> 0; NULL stays NULL unless ``null_to`` is given.  C7."""
    v = _col(c)
    expr = F.when(v < 0, F.lit(0))
    if null_to is not None:
        expr = expr.when(v.isNull(), F.lit(null_to))
    return expr.otherwise(v)


def default_false(c) -> Column:
    """A NULL boolean becomes FALSE.  C8."""
    return F.coalesce(_col(c).cast("boolean"), F.lit(False))
