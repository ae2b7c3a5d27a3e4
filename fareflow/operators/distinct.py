"""Distinct counts that merge (A2): a sketch per day, kept beside the exact count.

An exact distinct count of a longer period cannot be made from those of its days; it shuffles all
values again.  A sketch per day (HyperLogLog, ``2 ** lg_k`` registers, a few kB) is stored once; the
count of any set of days is a union of their sketches, with a relative error of about
1.04 / sqrt(``2 ** lg_k``) (1.6 % for 12).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, groups: Sequence[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """``groups``, ``rows``, ``sketch``: one sketch of the non-null values a group (built in the map tasks, then merged)."""
    return df.groupBy(*groups).agg(F.count(value).alias("rows"), F.hll_sketch_agg(F.col(value), F.lit(lg_k)).alias("sketch"))


def merged_counts(sketches: DataFrame, groups: Sequence[str], name: str = "estimate") -> DataFrame:
    """``groups``, ``rows`` and the estimated distinct count over all their sketches."""
    return (sketches.groupBy(*groups).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("_sketch"))
            .select(*groups, "rows", F.hll_sketch_estimate("_sketch").alias(name)).drop("_sketch"))


def exact_counts(df: DataFrame, groups: Sequence[str], value: str, name: str = "exact") -> DataFrame:
    """``groups`` and the exact distinct count: distinct rows first, so that a hot group is reduced in the map tasks."""
    return df.select(*groups, value).distinct().groupBy(*groups).agg(F.count(value).alias(name))
