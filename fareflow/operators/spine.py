"""Date spine and date-dimension attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.bands import is_weekend
from fareflow.functions.dates import part, week_sunday


def date_spine(spark: SparkSession, start: dt.date, days: int) -> DataFrame:
    """``start`` + 0..days (inclusive) as ``date_day``: days + 1 rows."""
    return spark.range(0, days + 1, numPartitions=max(1, min(64, (days + 1) // 512 or 1))) \
        .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))


def spine_between(df: DataFrame, date_col: str) -> DataFrame:
    """Every day from the earliest to the latest ``date_col`` of ``df``.

    One aggregate (min, max) with partial aggregation, then one row exploded
    into the days of that span; the span is bounded by the calendar, not by
    the row count.
    """
    bounds = df.agg(F.min(F.to_date(date_col)).alias("_lo"), F.max(F.to_date(date_col)).alias("_hi"))
    return bounds.filter(F.col("_lo").isNotNull()).select(
        F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def date_attributes(spine: DataFrame, col: str = "date_day") -> DataFrame:
    """M15 columns for every day of ``spine``."""
    d = F.col(col)
    return spine.select(
        F.date_format(d, "yyyyMMdd").alias("date_id"),
        d.alias("full_date"),
        part("YEAR", d).alias("year"),
        part("QUARTER", d).alias("quarter"),
        part("MONTH", d).alias("month"),
        week_sunday(d).alias("week"),
        part("DAY", d).alias("day"),
        part("DAYOFWEEK", d).alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        is_weekend(d).alias("is_weekend"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )
