"""Ranking operators.

``top_n_per`` is a per-group window with a ``rank <= n`` filter: Spark
inserts a partial WindowGroupLimit before the shuffle, so every map task
forwards at most the top rows (plus ties) of each group.

``global_rank`` is RANK() over the whole table without a single-partition
window, ``rank_within`` the same for groups of any size.  Ranges of the ranked
value get explicit splitters: percentiles, computed once by a mergeable sketch
and brought to the driver.  The range id of a row is then an expression over these
bounds, so the branch that ranks inside each range and the branch that counts the
rows per range agree without a kept copy, and equal values share a range.  Only the
per-range counts of hot groups meet in one place.  A group is hot with at least
1 / ``partitions`` of the rows (1 / ``MAX_RANGES`` at least); all others are ranked as
one range each.  The bounds of all hot groups are at most 128 x ``MAX_RANGES`` values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ranges of one group; with more, a range is found by two steps over fewer splitters each.
MAX_RANGES = 4096
_STEP = 64


def _order(cols: Sequence[str]):
    return [F.col(c).desc_nulls_last() for c in cols]


def rank_within(df: DataFrame, partition: Sequence[str], order_desc: Sequence[str],
                name: str = "rank", partitions: int | None = None) -> DataFrame:
    """RANK() OVER (PARTITION BY partition ORDER BY order_desc DESC): ties share, gaps follow.

    Computed like ``global_rank`` with the group columns leading the range
    key, so a group holding a large share of the rows spans several ranges
    instead of one task.
    """
    return _ranked(df, list(partition), list(order_desc), name, partitions)


def top_n_per(df: DataFrame, partition: Sequence[str], order_desc: Sequence[str], n: int,
              name: str = "rank") -> DataFrame:
    """Rows ranked ``<= n`` within their group (ties at the cut are all kept).

    A window rank with the filter directly above it: Spark plans a partial
    WindowGroupLimit before the shuffle, so at most n rows (plus ties) per
    group leave each map task.
    """
    w = Window.partitionBy(*partition).orderBy(*_order(order_desc))
    return df.withColumn(name, F.rank().over(w).cast("bigint")).filter(F.col(name) <= n)


def global_rank(df: DataFrame, order_desc: str, name: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """RANK() OVER (ORDER BY order_desc DESC NULLS LAST) computed in parallel."""
    return _ranked(df, [], [order_desc], name, partitions)


def _splitters(df: DataFrame, value: str, ranges: int, groups: Sequence[str] = ()) -> DataFrame:
    """``groups``, ``_bounds``: per group its rows and up to ``ranges - 1`` percentiles of ``value``, ascending and distinct.

    The sketch is mergeable (partial aggregation), so a hot group is reduced in the map tasks."""
    if not isinstance(df.schema[value].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{value}: ranges need a number, a date or a timestamp")
    at = [i / ranges for i in range(1, ranges)] or [0.5]
    bounds = F.percentile_approx(value, at, max(10_000, 4 * ranges))
    return df.groupBy(*groups).agg(F.array_sort(F.array_distinct(F.coalesce(bounds, F.array().cast(T.ArrayType(df.schema[value].dataType))))).alias("_bounds"))


def range_id(value: str, bounds: Column) -> Column:
    """How many of the ascending ``bounds`` (an array) are below the value (null: -1): equal values share an id.

    A coarse step over every 64th bound, then one over the 64 from there: two short searches
    instead of one over thousands."""
    def below(of: Column) -> Column:
        return F.size(F.filter(of, lambda b: b < F.col(value)))

    steps = F.floor(F.size(bounds) / _STEP).cast("int")
    marks = F.when(steps > 0, F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda i: F.get(bounds, i * _STEP - 1)))
    coarse = F.coalesce(below(marks), F.lit(0)) * _STEP
    return F.when(F.col(value).isNull(), -1).otherwise(coarse + below(F.slice(bounds, coarse + 1, F.lit(_STEP))))


def _ranked(df: DataFrame, partition: list[str], order_desc: list[str], name: str,
            partitions: int | None) -> DataFrame:
    """Rank by range: rank inside each range, plus the rows of the same group in all higher ranges."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(n, MAX_RANGES)
    value = order_desc[0]  # ranges by the first column: rows equal in it share a range
    if partition:
        counts = df.groupBy(*partition).agg(F.count(F.lit(1)).alias("_rows"))
        total = counts.agg(F.sum("_rows")).first()[0] or 0
        hot = counts.where((F.col("_rows") * ranges >= total) & (F.col("_rows") > 1)).collect()  # at most MAX_RANGES groups
        found = []
        for few, many in ((True, ranges), (False, min(ranges, _STEP))):  # up to 64 groups with many bounds, the others with few
            own = [tuple(r)[:-1] for r in hot if (r["_rows"] * _STEP >= total) == few]
            if own:
                keys = spark.createDataFrame(own, df.select(*partition).schema)
                same = [df[c].eqNullSafe(keys[c]) for c in partition]
                found += [tuple(r) for r in _splitters(df.join(F.broadcast(keys), same, "left_semi"), value, max(2, many), partition).collect()]
        schema = T.StructType([*(T.StructField(f"_of_{c}", df.schema[c].dataType) for c in partition),
                               T.StructField("_bounds", T.ArrayType(df.schema[value].dataType))])
        bounds = spark.createDataFrame(found, schema)
        ranged = df.join(F.broadcast(bounds), [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in partition], "left")
        ranged = ranged.withColumn("_range", F.when(F.col("_bounds").isNull(), 0).otherwise(range_id(value, F.col("_bounds"))))
        ranged = ranged.withColumn("_hot", F.col("_bounds").isNotNull()).select(*df.columns, "_range", "_hot")
    else:
        whole = _splitters(df, value, ranges).first()["_bounds"]
        literal = F.array(*[F.lit(b) for b in whole]).cast(T.ArrayType(df.schema[value].dataType))
        ranged = df.withColumn("_range", range_id(value, literal)).withColumn("_hot", F.lit(True))
    local = F.rank().over(Window.partitionBy(*partition, "_range").orderBy(*_order(order_desc)))
    # ranges are dealt in order, each whole: neighbours make up a partition, none is hashed onto another
    out = ranged.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in partition], F.col("_range").desc()).withColumn("_local", local)
    # one row per range of a hot group: the rows in the ranges above
    sizes = ranged.where("_hot").groupBy(*partition, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    above = Window.partitionBy(*partition).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"_of_{c}") for c in partition], F.col("_range").alias("_of_range"),
                           F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_above"))
    same = F.col("_range") == F.col("_of_range")
    for c in partition:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = out.join(F.broadcast(offsets), same, "left")  # no more rows than there are bounds
    return joined.select(*[F.col(c) for c in df.columns], (F.col("_local") + F.coalesce("_above", F.lit(0))).cast("bigint").alias(name))
