"""Join each row to a statistic of its own group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_stat_back(df: DataFrame, key: str, aggs: dict[str, Column], bounded: bool = False,
                    stats_from: DataFrame | None = None) -> DataFrame:
    """``df`` + one column per aggregate of the row's ``key`` group.

    The statistic is computed with a hash aggregate (partial, map-side) and
    joined back with plain equality, so a NULL key forms a group but never
    matches back.  ``bounded=True`` states that ``key`` has a fixed small
    domain (an enum); the statistic is then broadcast.  Otherwise the join is
    left to the planner (AQE broadcasts it at runtime when it is small).
    ``stats_from``: a cheaper input with the same rows per group (e.g. the
    table ``df`` was built from by a row-preserving lookup), so ``df`` is not
    computed twice.
    """
    src = stats_from if stats_from is not None else df
    stats = src.groupBy(key).agg(*[expr.alias(name) for name, expr in aggs.items()]) \
        .filter(F.col(key).isNotNull()).withColumnRenamed(key, "_stat_key")
    if bounded:
        stats = F.broadcast(stats)
    return df.join(stats, df[key] == stats["_stat_key"], "left").drop("_stat_key")
