"""Date and time expressions with the warehouse's semantics.

* ``elapsed``: whole elapsed units between two timestamps (TIMESTAMP_DIFF).
* ``days_between``: calendar days between two dates (DATE_DIFF DAY).
* ``months_crossed``: month boundaries crossed (DATE_DIFF MONTH); Spark's
  ``timestampdiff(MONTH)`` counts whole months instead, which differs.
* ``week_sunday``: week of year with weeks starting on Sunday, days before the
  first Sunday in week 0 (EXTRACT WEEK); ``weekofyear`` is ISO and differs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date(d) -> Column:
    if isinstance(d, (dt.date, dt.datetime)) and not isinstance(d, Column):
        return F.lit(d if not isinstance(d, dt.datetime) else d.date())
    return _col(d)


def elapsed(unit: str, start, end) -> Column:
    """Whole ``unit`` s from ``start`` to ``end`` (bigint)."""
    return F.timestamp_diff(unit.upper(), _col(start), _col(end)).cast("bigint")


def days_between(start, end) -> Column:
    """Days from date ``start`` to date ``end`` (bigint)."""
    return F.datediff(_date(end), _date(start)).cast("bigint")


def months_crossed(start, end) -> Column:
    """Month boundaries crossed from ``start`` to ``end`` (bigint)."""
    s, e = _date(start), _date(end)
    return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("bigint")


def week_sunday(d) -> Column:
    """Week number, Sunday-start weeks, week 0 before the first Sunday."""
    v = _col(d)
    return F.floor((F.dayofyear(v) + F.lit(7) - F.dayofweek(v)) / F.lit(7)).cast("bigint")


def part(unit: str, d) -> Column:
    """EXTRACT(unit FROM d) as bigint for YEAR QUARTER MONTH DAY HOUR DAYOFWEEK."""
    fn = {"YEAR": F.year, "QUARTER": F.quarter, "MONTH": F.month, "DAY": F.dayofmonth,
          "HOUR": F.hour, "DAYOFWEEK": F.dayofweek, "WEEK": week_sunday}[unit.upper()]
    return fn(_col(d)).cast("bigint")


def trailing_days(df, date_col: str, n: int, as_of):
    """F8: rows whose ``date_col`` is on or after ``as_of - n`` days.

    ``as_of`` is a literal, so on a date-partitioned table the predicate
    becomes a partition filter.
    """
    start = as_of - dt.timedelta(days=n)
    return df.filter(F.col(date_col) >= F.lit(start))
