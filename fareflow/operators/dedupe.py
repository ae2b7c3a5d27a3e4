"""Keep the latest row per key (W1 + F1 + F7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                  tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``order_desc`` values.

    Rows whose key is NULL are dropped first.  Ties on ``order_desc`` are
    broken by ``tiebreak`` (descending); when not given, by every other column
    in schema order, so the surviving row never depends on arrival order.

    Plan: ``row_number() = 1`` becomes a partial WindowGroupLimit before the
    shuffle, so every map task forwards at most one row per key; a key that
    holds a large share of the rows is reduced map-side and does not land in
    one reduce task whole.
    """
    keys, order_desc = list(keys), list(order_desc)
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c not in order_desc]
    order = [F.col(c).desc_nulls_last() for c in list(order_desc) + list(tiebreak)]
    w = Window.partitionBy(*keys).orderBy(*order)
    not_null = None
    for k in keys:
        cond = F.col(k).isNotNull()
        not_null = cond if not_null is None else not_null & cond
    return (df.filter(not_null)
            .withColumn("_row_num", F.row_number().over(w))
            .filter(F.col("_row_num") == 1)
            .drop("_row_num"))
