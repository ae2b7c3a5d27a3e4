"""Rates and averages with exact, engine-independent arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_pct(num, den, scale: int = 2) -> Column:
    """round(num * 100 / den, scale); NULL when ``den`` is 0 (SAFE_DIVIDE)."""
    return F.round(F.try_divide((_col(num) * 100).cast("double"), _col(den).cast("double")), scale)


def safe_divide(num, den) -> Column:
    """num / den as double, NULL when den is 0."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def exact_avg(c) -> Column:
    """AVG that skips NULLs: exact SUM, then one double division.

    Decimal AVG rounds to an engine-specific scale; summing exactly and
    dividing once gives the same double in every engine.  The partial
    aggregate is still a plain sum + count (map-side combine).
    """
    v = _col(c)
    return F.try_divide(F.sum(v).cast("double"), F.count(v).cast("double"))
