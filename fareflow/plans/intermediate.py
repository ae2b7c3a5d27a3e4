"""Intermediate models M7-M11."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions import bands
from fareflow.functions.dates import days_between, elapsed, months_crossed, part
from fareflow.functions.rates import exact_avg, safe_divide, safe_pct
from fareflow.operators.fraud import duplicate_payments, fraud_flags
from fareflow.operators.group_stats import group_stat_back
from fareflow.operators.joins import fanout_left_join, hot_keys, lookup_left_join
from fareflow.operators.sessions import pair_sessions
from fareflow.session import DEFAULT_AS_OF

TRIP_STATUSES = ["completed", "cancelled", "no_show"]


def trip_hot_keys(stg_payments: DataFrame, **kw) -> DataFrame:
    """Trips holding a large share of all payments (bounded, broadcastable)."""
    return hot_keys(duplicate_payments(stg_payments), "trip_id", count_col="payment_attempts", **kw)


def int_trip_details(stg_trips: DataFrame, stg_payments: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """M7: every trip x payment row with fraud indicators.

    The per-trip payment count joins the trips 1:1 first; the fan-out join to
    payments then keeps trips whose payments form a hot key apart.
    """
    hot = hot if hot is not None else trip_hot_keys(stg_payments)
    trips = stg_trips.filter(F.col("trip_status").isin(TRIP_STATUSES))
    dup = duplicate_payments(stg_payments)
    t = trips.join(dup, "trip_id", "left")
    p = stg_payments.select("trip_id", "payment_id", "payment_status", "payment_provider",
                            F.col("amount").alias("payment_amount"),
                            F.col("fee").alias("processing_fee"), "currency")
    j = fraud_flags(fanout_left_join(t, p, "trip_id", hot))
    net = bands.net_revenue("actual_fare", "processing_fee")
    return j.select(
        "trip_id", "rider_id", "driver_id", "city_id", "vehicle_id",
        "requested_at", "pickup_at", "dropoff_at",
        bands.trip_duration("trip_status", "pickup_at", "dropoff_at").alias("trip_duration_minutes"),
        "estimated_fare", "actual_fare", "surge_multiplier",
        bands.trip_type("is_corporate").alias("trip_type"),
        F.col("is_corporate").alias("is_corporate_trip"),
        "payment_id", "payment_status", "payment_provider", "payment_amount", "processing_fee", "currency",
        net.alias("net_revenue"),
        F.coalesce(F.col("has_duplicate_payments"), F.lit(False)).alias("has_duplicate_payments"),
        F.coalesce(F.col("payment_attempts"), F.lit(0)).cast("bigint").alias("payment_attempts"),
        "fraud_duplicate_payments", "fraud_failed_payment", "fraud_extreme_surge",
        "fraud_no_payment", "fraud_amount_mismatch", "is_fraud_flag",
        bands.surge_band("surge_multiplier").alias("surge_impact_category"),
        F.col("actual_fare").alias("gross_revenue"),
        net.alias("net_revenue_amount"),
        "created_at", "updated_at", "trip_status", "payment_method",
    )


def int_payment_analysis(stg_payments: DataFrame, stg_trips: DataFrame,
                         hot: DataFrame | None = None) -> DataFrame:
    """M8: payments with trip facts, date parts, rates and the provider failure rate.

    Payments -> trips is a lookup (trips unique per trip_id); trips with a
    hot payment count are kept apart.  The provider statistic is joined back by
    broadcast: the provider is a whitelisted enum, so the statistic has at
    most three rows.  NULL providers form a group but never match back (J6).
    """
    hot = hot if hot is not None else trip_hot_keys(stg_payments)
    trips = stg_trips.select("trip_id", "trip_status", "actual_fare")
    pa = lookup_left_join(stg_payments, trips, "trip_id", hot=hot, keyed=True)  # staging requires the trip
    pa = pa.select(
        "payment_id", "trip_id", "payment_status", "payment_provider", "amount", "fee", "currency",
        "created_at", "trip_status", "actual_fare",
        F.to_date("created_at").alias("payment_date"),
        part("HOUR", "created_at").alias("payment_hour"),
        part("DAYOFWEEK", "created_at").alias("payment_day_of_week"),
        bands.status_flag("payment_status", "success").alias("is_successful"),
        bands.status_flag("payment_status", "failed").alias("is_failed"),
        bands.fee_percentage("fee", "amount").alias("fee_percentage"),
        bands.amount_difference("amount", "actual_fare").alias("amount_difference"),
    )
    # the lookup keeps exactly one row per payment, so the provider statistic
    # is taken from the payments directly instead of a second join
    flags = stg_payments.select("payment_provider",
                                bands.status_flag("payment_status", "failed").alias("is_failed"))
    return group_stat_back(
        pa, "payment_provider",
        {"provider_failure_rate": safe_pct(F.sum("is_failed"), F.count(F.lit(1)))},
        bounded=True, stats_from=flags)


def int_driver_activity(stg_status_events: DataFrame, chunk: str = "day") -> DataFrame:
    """M9: online -> offline sessions per driver and day."""
    s = pair_sessions(stg_status_events, chunk=chunk)
    return (s.filter(F.col("session_duration_minutes").isNotNull())
            .groupBy("driver_id", "activity_date")
            .agg(F.count(F.lit(1)).alias("online_sessions"),
                 exact_avg("session_duration_minutes").alias("avg_session_duration"),
                 F.sum("session_duration_minutes").alias("total_online_minutes"),
                 F.min("session_start").alias("first_online"),
                 F.max("session_start").alias("last_online")))


def driver_trip_stats(stg_trips: DataFrame) -> DataFrame:
    """Completed-trip statistics per driver."""
    t = stg_trips.filter(F.col("trip_status") == "completed")
    first, last = F.min("requested_at"), F.max("requested_at")
    return (t.groupBy("driver_id")
            .agg(F.count(F.lit(1)).alias("lifetime_trips"),
                 F.sum("actual_fare").alias("lifetime_revenue"),
                 exact_avg("actual_fare").alias("avg_trip_fare"),
                 first.alias("first_trip_date"),
                 last.alias("last_trip_date"),
                 F.count_distinct(F.to_date("requested_at")).alias("days_active"),
                 safe_divide(F.count(F.lit(1)), elapsed("DAY", first, last) + 1).alias("avg_trips_per_active_day")))


def status_event_counts(stg_status_events: DataFrame) -> DataFrame:
    """Status-event activity per driver."""
    return (stg_status_events.groupBy("driver_id")
            .agg(F.count(F.lit(1)).alias("total_status_changes"),
                 F.sum(bands.status_flag("driver_status", "online")).alias("online_events"),
                 F.sum(bands.status_flag("driver_status", "offline")).alias("offline_events"),
                 F.min("event_timestamp").alias("first_event"),
                 F.max("event_timestamp").alias("last_event")))


def driver_metrics(stg_trips: DataFrame, stg_drivers: DataFrame, stg_status_events: DataFrame,
                   as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """One row per driver with tenure, trip, activity and health metrics.

    Both statistics are aggregated per driver before the joins (partial
    aggregation absorbs a driver holding a large share of trips), so the
    joins are 1:1 on driver_id.
    """
    dts = driver_trip_stats(stg_trips)
    da = status_event_counts(stg_status_events)
    j = stg_drivers.join(dts, "driver_id", "left").join(da, "driver_id", "left")
    return j.select(
        "driver_id", "driver_status", "city_id", "rating", "onboarding_date",
        days_between("onboarding_date", as_of).alias("days_as_driver"),
        months_crossed("onboarding_date", as_of).alias("months_as_driver"),
        F.coalesce(F.col("lifetime_trips"), F.lit(0)).cast("bigint").alias("lifetime_trips"),
        F.coalesce(F.col("lifetime_revenue"), F.lit(0)).alias("lifetime_revenue"),
        F.coalesce(F.col("avg_trip_fare"), F.lit(0.0)).alias("avg_trip_fare"),
        "first_trip_date", "last_trip_date",
        F.coalesce(F.col("days_active"), F.lit(0)).cast("bigint").alias("days_active"),
        "total_status_changes", "online_events", "offline_events", "first_event", "last_event",
        bands.driver_health("driver_status", "last_trip_date", as_of).alias("driver_health_status"),
        bands.rating_category("rating").alias("rating_category"),
        bands.driver_tier("lifetime_trips").alias("driver_tier"),
        "avg_trips_per_active_day",
    )


def rider_trip_stats(stg_trips: DataFrame) -> DataFrame:
    """Completed-trip statistics per rider, corporate/personal split."""
    t = stg_trips.filter(F.col("trip_status") == "completed")
    first, last = F.min("requested_at"), F.max("requested_at")
    corp = F.col("is_corporate") == F.lit(True)
    pers = F.col("is_corporate") == F.lit(False)
    zero = F.lit(0).cast("decimal(28,9)")
    return (t.groupBy("rider_id")
            .agg(F.count(F.lit(1)).alias("lifetime_trips"),
                 F.sum("actual_fare").alias("lifetime_revenue"),
                 exact_avg("actual_fare").alias("avg_trip_value"),
                 first.alias("first_trip_date"),
                 last.alias("last_trip_date"),
                 elapsed("DAY", first, last).alias("customer_lifetime_days"),
                 safe_divide(F.count(F.lit(1)) * 30, elapsed("DAY", first, last) + 1).alias("avg_trips_per_month"),
                 F.sum(F.when(corp, F.col("actual_fare")).otherwise(zero)).alias("corporate_revenue"),
                 F.sum(F.when(pers, F.col("actual_fare")).otherwise(zero)).alias("personal_revenue"),
                 F.count_if(F.coalesce(corp, F.lit(False))).alias("corporate_trips"),
                 F.count_if(F.coalesce(pers, F.lit(False))).alias("personal_trips")))


def rider_metrics(stg_trips: DataFrame, stg_riders: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """One row per rider with value segment, status and referral outcome."""
    rt = rider_trip_stats(stg_trips).withColumnRenamed("lifetime_trips", "_trips") \
        .withColumnRenamed("lifetime_revenue", "_revenue")
    j = stg_riders.join(rt, "rider_id", "left")
    zero = F.lit(0)
    return j.select(
        "rider_id", "signup_date", "country_code",
        bands.region("country_code").alias("region"),
        "referral_code",
        days_between("signup_date", as_of).alias("days_as_rider"),
        F.coalesce(F.col("_trips"), zero).cast("bigint").alias("lifetime_trips"),
        F.coalesce(F.col("_revenue"), zero).alias("rider_ltv"),
        F.coalesce(F.col("avg_trip_value"), F.lit(0.0)).alias("avg_trip_value"),
        "first_trip_date", "last_trip_date",
        bands.ltv_segment("_revenue", "first_trip_date").alias("ltv_segment"),
        bands.rider_status("first_trip_date", "last_trip_date", as_of).alias("rider_status"),
        F.coalesce(F.col("corporate_trips"), zero).cast("bigint").alias("corporate_trips"),
        F.coalesce(F.col("personal_trips"), zero).cast("bigint").alias("personal_trips"),
        F.coalesce(F.col("corporate_revenue"), zero).alias("corporate_revenue"),
        F.coalesce(F.col("personal_revenue"), zero).alias("personal_revenue"),
        bands.referral_effectiveness("referral_code", "_trips").alias("referral_effectiveness"),
        "customer_lifetime_days", "avg_trips_per_month",
    )
