"""Mart models M12-M20: dimensions, the trip fact and the published reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions import bands
from fareflow.functions.dates import days_between, months_crossed, part, trailing_days
from fareflow.functions.keys import surrogate_key
from fareflow.functions.rates import exact_avg, safe_divide, safe_pct
from fareflow.operators.fraud import FRAUD_FLAGS, payment_summary, trip_fraud_flags
from fareflow.operators.joins import Lookup, lookup_all
from fareflow.operators.ranking import global_rank, top_n_per
from fareflow.operators.spine import date_attributes, date_spine, spine_between
from fareflow.session import DEFAULT_AS_OF

# Date dimension span: 2020-01-01 plus offsets 0..3650 (fixed values).
DIM_DATES_START = dt.date(2020, 1, 1)
DIM_DATES_DAYS = 3650
LEADERBOARD_DAYS = 30
LEADERBOARD_TOP = 10
FRAUD_WINDOW_DAYS = 7


def _ts(d: dt.date):
    return F.lit(dt.datetime(d.year, d.month, d.day)).cast("timestamp")


def dim_cities(stg_cities: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """City dimension with market type and age."""
    return stg_cities.select(
        surrogate_key("city_id").alias("city_sk"),
        "city_id", "city_name", "country_code", "launch_date",
        bands.market_type("country_code").alias("market_type"),
        part("YEAR", "launch_date").alias("launch_year"),
        part("MONTH", "launch_date").alias("launch_month"),
        days_between("launch_date", as_of).alias("days_operating"),
        months_crossed("launch_date", as_of).alias("months_operating"),
    )


def dim_drivers(driver_metrics: DataFrame, valid_from: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Driver dimension, one current version per driver."""
    return driver_metrics.select(
        surrogate_key("driver_id").alias("driver_sk"),
        "driver_id", "driver_status", "city_id", "rating", "onboarding_date",
        "driver_tier", "rating_category", "driver_health_status",
        "lifetime_trips", "lifetime_revenue", "avg_trip_fare", "days_active",
        part("YEAR", "onboarding_date").alias("onboarding_year"),
        part("MONTH", "onboarding_date").alias("onboarding_month"),
        _ts(valid_from).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_riders(rider_metrics: DataFrame, valid_from: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Rider dimension, one current version per rider."""
    return rider_metrics.select(
        surrogate_key("rider_id").alias("rider_sk"),
        "rider_id", "signup_date", "country_code", "region", "ltv_segment", "rider_status",
        "lifetime_trips", "rider_ltv", "avg_trip_value", "corporate_trips", "personal_trips",
        "corporate_revenue", "personal_revenue",
        part("YEAR", "signup_date").alias("signup_year"),
        part("MONTH", "signup_date").alias("signup_month"),
        _ts(valid_from).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_dates(spark, start: dt.date = DIM_DATES_START, days: int = DIM_DATES_DAYS) -> DataFrame:
    """The calendar dimension (fixed span)."""
    return date_attributes(date_spine(spark, start, days))


def trip_calendar(stg_trips: DataFrame) -> DataFrame:
    """The date dimension over the span of the trip data (data-derived spine)."""
    return date_attributes(spine_between(stg_trips, "requested_at"))


def fact_status() -> Column:
    """Whether a staged trip's status is one of the fact's."""
    return F.col("trip_status").isin("completed", "cancelled", "no_show")


def trip_grain(stg_trips: DataFrame, stg_payments: DataFrame, *more: str) -> DataFrame:
    """Trip details at one row per trip (the fact's grain), and the trips' columns ``more``.

    Payments are summarised per trip first (partial aggregation), then
    joined 1:1 to the trips; the chosen payment's fee gives net revenue and
    each fraud flag is "fired on any of the trip's payments".
    """
    trips = stg_trips.filter(fact_status())
    j = trip_fraud_flags(trips.join(payment_summary(stg_payments), "trip_id", "left"))
    return j.select(
        "trip_id", "rider_id", "driver_id", "city_id", "requested_at", "pickup_at", "dropoff_at",
        bands.trip_duration("trip_status", "pickup_at", "dropoff_at").alias("trip_duration_minutes"),
        "actual_fare", "surge_multiplier",
        bands.trip_type("is_corporate").alias("trip_type"),
        F.col("is_corporate").alias("is_corporate_trip"),
        bands.net_revenue("actual_fare", "chosen_fee").alias("net_revenue"),
        F.coalesce(F.col("has_duplicate_payments"), F.lit(False)).alias("has_duplicate_payments"),
        *FRAUD_FLAGS, "is_fraud_flag",
        bands.surge_band("surge_multiplier").alias("surge_impact_category"),
        "created_at", "updated_at", "trip_status", "payment_method", *more,
    )


def collapse_payments(trip_details: DataFrame, stg_payments: DataFrame) -> DataFrame:
    """B6 on the fan-out itself: one row per trip of ``int_trip_details``.

    The chosen row is the trip's payment with success first, then latest
    ``created_at`` (looked up by payment_id), then highest payment_id; every
    fraud flag is true when any of the trip's rows has it.  Same result as
    ``trip_grain``, which the fact uses because it aggregates the payments
    before the join instead of after the fan-out.
    """
    created = stg_payments.select("payment_id", F.col("created_at").alias("_paid_at"))
    td = trip_details.join(created, "payment_id", "left")
    order = F.struct(F.when(F.col("payment_status") == "success", 1).otherwise(0),
                     F.col("_paid_at"), F.col("payment_id"))
    keep = [c for c in trip_details.columns if c not in FRAUD_FLAGS + ["is_fraud_flag", "trip_id"]]
    picked = [F.max_by(F.col(c), order).alias(c) for c in keep]
    flags = [F.bool_or(F.col(c)).alias(c) for c in FRAUD_FLAGS + ["is_fraud_flag"]]
    return td.groupBy("trip_id").agg(*picked, *flags).select("trip_id", *[c for c in trip_details.columns
                                                                          if c != "trip_id"])


def fact_trips(trips: DataFrame, dim_drivers: DataFrame, dim_riders: DataFrame, dim_cities: DataFrame,
               inserted_at: dt.date = DEFAULT_AS_OF, broadcast_max_rows: int = 2_000_000,
               driver_hot: DataFrame | None = None, rider_hot: DataFrame | None = None, more: Sequence[str] = ()) -> DataFrame:
    """The trip fact, keyed by trip_sk, with surrogate keys of current dims (J7, I4), and the trips' columns ``more``.

    ``trips`` is trip-grain (``trip_grain``) or a delta of it.  Each dim
    lookup broadcasts the (key, sk) pairs when a row count proves them small,
    else shuffles the trips once, with the rows of hot keys (a driver with a
    third of all trips) dealt evenly and looked up in a broadcast of just
    their dim rows.
    """
    drivers = dim_drivers.filter("is_current").select("driver_id", "driver_sk")
    riders = dim_riders.filter("is_current").select("rider_id", "rider_sk")
    cities = dim_cities.select("city_id", "city_sk")
    f = lookup_all(trips, [Lookup(drivers, "driver_id", size_of=dim_drivers, hot=driver_hot),
                           Lookup(riders, "rider_id", size_of=dim_riders, hot=rider_hot),
                           Lookup(cities, "city_id", size_of=dim_cities)], broadcast_max_rows)
    return f.select(
        surrogate_key("trip_id").alias("trip_sk"),
        "driver_sk", "rider_sk", "city_sk",
        F.to_date("requested_at").alias("trip_date"),
        F.lit(1).cast("bigint").alias("trip_count"),
        F.col("actual_fare").alias("gross_revenue"),
        "net_revenue", "surge_multiplier", "trip_duration_minutes", "trip_type", "is_fraud_flag",
        "surge_impact_category", "requested_at", "pickup_at", "dropoff_at", "created_at",
        _ts(inserted_at).alias("inserted_at"),
        "trip_id", "trip_status", "payment_method", "is_corporate_trip", "has_duplicate_payments",
        *FRAUD_FLAGS, "updated_at", *more,
    )


def _dims(fact: DataFrame, dims: list[tuple[DataFrame, str, list[str]]], broadcast_max_rows: int) -> DataFrame:
    """Inner joins of the fact to dimensions on their surrogate keys (J8-J10), all in one go."""
    return lookup_all(fact, [Lookup(dim.select(sk, *cols), sk, "inner", size_of=dim) for dim, sk, cols in dims], broadcast_max_rows)


def daily_revenue(fact: DataFrame, dim_cities: DataFrame, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Revenue per day and city.

    ``total_trips`` counts trip ids: the fact holds one row per trip (its
    merge key), so the distinct count equals the plain count and needs no
    extra shuffle on trip_id.
    """
    j = _dims(fact, [(dim_cities, "city_sk", ["city_name", "country_code"])], broadcast_max_rows)
    zero = F.lit(0).cast("decimal(28,9)")
    return (j.groupBy(F.to_date("requested_at").alias("revenue_date"), "city_name", "country_code")
            .agg(F.count("trip_id").alias("total_trips"),
                 F.sum("gross_revenue").alias("gross_revenue"),
                 F.sum("net_revenue").alias("net_revenue"),
                 F.sum(F.when(F.col("trip_type") == "Corporate", F.col("gross_revenue")).otherwise(zero))
                  .alias("corporate_revenue"),
                 F.sum(F.when(F.col("trip_type") == "Personal", F.col("gross_revenue")).otherwise(zero))
                  .alias("personal_revenue"),
                 F.sum(F.when(F.col("is_fraud_flag"), 1).otherwise(0)).cast("bigint").alias("fraud_trips"),
                 exact_avg("trip_duration_minutes").alias("avg_trip_duration"),
                 exact_avg("gross_revenue").alias("avg_ticket_size")))


def drivers_leaderboard(fact: DataFrame, dim_drivers: DataFrame, dim_cities: DataFrame,
                        as_of: dt.date = DEFAULT_AS_OF, days: int = LEADERBOARD_DAYS,
                        top: int = LEADERBOARD_TOP, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Top drivers by completed-trip revenue per city over the trailing window.

    The date filter is a literal on ``trip_date`` (a partition filter on the
    stored fact).  Revenue is aggregated per driver and city first; the
    overall rank is then a distributed global rank over those rows and the
    city rank a per-city window cut at ``top``.
    """
    f = trailing_days(fact, "trip_date", days, as_of).filter(F.col("trip_status") == "completed")
    # trips are summed per driver and city before any join: a busy driver is combined in the map tasks
    per = f.groupBy("driver_sk", "city_sk").agg(
        F.count("trip_id").alias("_trips"), F.sum("gross_revenue").alias("_revenue"),
        F.sum("trip_duration_minutes").alias("_minutes"), F.count("trip_duration_minutes").alias("_timed"))
    j = _dims(per, [(dim_drivers, "driver_sk", ["driver_id", "driver_status", "driver_tier", "rating_category"]),
                    (dim_cities, "city_sk", ["city_name"])], broadcast_max_rows)
    agg = (j.groupBy("driver_id", "driver_status", "driver_tier", "rating_category", "city_name")
           .agg(F.sum("_trips").alias("trips_completed"),
                F.sum("_revenue").alias("total_revenue"),
                safe_divide(F.sum("_minutes"), F.sum("_timed")).alias("avg_trip_time")))
    ranked = global_rank(agg, "total_revenue", name="overall_rank")
    return top_n_per(ranked, ["city_name"], ["total_revenue"], top, name="city_rank").select(
        "driver_id", "driver_status", "driver_tier", "rating_category", "city_name",
        "trips_completed", "total_revenue", "avg_trip_time", "city_rank", "overall_rank")


def fraud_monitoring(fact: DataFrame, dim_cities: DataFrame, dim_drivers: DataFrame, dim_riders: DataFrame,
                     as_of: dt.date = DEFAULT_AS_OF, days: int = FRAUD_WINDOW_DAYS,
                     broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Flagged trips of the trailing window with their first-matching reason."""
    f = trailing_days(fact, "trip_date", days, as_of).filter(F.col("is_fraud_flag") == F.lit(True))
    j = _dims(f, [(dim_cities, "city_sk", ["city_name"]), (dim_drivers, "driver_sk", ["driver_id"]),
                  (dim_riders, "rider_sk", ["rider_id"])], broadcast_max_rows)
    return j.select(
        "trip_id", F.to_date("requested_at").alias("fraud_date"), "city_name", "driver_id", "rider_id",
        "gross_revenue", "is_fraud_flag", bands.fraud_reason().alias("fraud_reason"),
        "payment_method", "trip_type")


def payments_reliability(stg_payments: DataFrame) -> DataFrame:
    """Daily payment volume and failure rate per provider.

    One hash aggregate keyed by (day, provider) with map-side partial
    aggregation: a provider holding most payments is combined per map task
    before the shuffle.  ORDER BY is applied by readers (``ordered``).
    """
    failed = bands.status_flag("payment_status", "failed")
    success = bands.status_flag("payment_status", "success")
    return (stg_payments
            .groupBy(F.to_date("created_at").alias("payment_date"), "payment_provider")
            .agg(F.count(F.lit(1)).alias("total_payments"),
                 F.sum(success).alias("successful_payments"),
                 F.sum(failed).alias("failed_payments"),
                 safe_pct(F.sum(failed), F.count(F.lit(1))).alias("failure_rate_percentage"),
                 F.sum("amount").alias("total_amount"),
                 exact_avg("amount").alias("avg_payment_amount")))


# reader-side ORDER BY of each report (a stored table keeps no order)
REPORT_ORDER = {
    "payments_reliability": [("payment_date", "desc"), ("failure_rate_percentage", "desc")],
    "daily_revenue": [("revenue_date", "desc"), ("city_name", "asc")],
    "drivers_leaderboard": [("city_name", "asc"), ("city_rank", "asc")],
    "fraud_monitoring": [("fraud_date", "desc"), ("gross_revenue", "desc")],
}


def ordered(df: DataFrame, report: str) -> DataFrame:
    """O1: the report's published order, applied when it is read."""
    return df.orderBy(*[F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in REPORT_ORDER[report]])
