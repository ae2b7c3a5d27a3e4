"""Staging models M1-M6: filter null keys, keep the latest row, type and clean.

Order in every model: key not null (F1) -> dedup (W1) -> casts and cleaning
(C*) -> required columns not null (F2).  The final filter stays after the dedup
on purpose: pushing it below ROW_NUMBER would change which row survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fareflow.functions.clean import (blank_default, clamp, clean_enum, default_false, floor_zero,
                                      trim_ws, whitelist)
from fareflow.operators.dedupe import dedupe_latest
from fareflow.sources.raw import MONEY

TS = "timestamp"
PAYMENT_STATUSES = ["success", "failed"]
PAYMENT_PROVIDERS = ["stripe", "paypal"]
DRIVER_EVENT_STATUSES = ["online", "offline"]


def _kept(df: DataFrame, keys: Observation | None) -> DataFrame:
    """The rows that the dedup kept, counted (``n``) where a run asks for it."""
    return df.observe(keys, F.count(F.lit(1)).alias("n")) if keys is not None else df


def _require(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def stg_trips(trips_raw: DataFrame, keys: Observation | None = None) -> DataFrame:
    """M1: one row per trip, latest ``updated_at``."""
    return cleaned_trips(_kept(latest_trips(trips_raw), keys)).filter(staged_trip())


def latest_trips(trips_raw: DataFrame) -> DataFrame:
    return dedupe_latest(trips_raw, ["trip_id"], ["updated_at"])


def staged_trip() -> Column:
    """Whether staging keeps a trip of ``cleaned_trips``."""
    return F.col("trip_id").isNotNull() & F.col("rider_id").isNotNull() & F.col("driver_id").isNotNull()


def cleaned_trips(latest: DataFrame, *more: Column) -> DataFrame:
    """The typed and cleaned columns of raw trips, and ``more`` of them."""
    return latest.select(
        F.col("trip_id").cast("bigint").alias("trip_id"),
        F.col("rider_id").cast("bigint").alias("rider_id"),
        F.col("driver_id").cast("bigint").alias("driver_id"),
        F.col("vehicle_id"),
        F.col("city_id").cast("bigint").alias("city_id"),
        F.col("requested_at").cast(TS).alias("requested_at"),
        F.col("pickup_at").cast(TS).alias("pickup_at"),
        F.col("dropoff_at").cast(TS).alias("dropoff_at"),
        clean_enum("status").alias("trip_status"),
        F.col("estimated_fare").cast(MONEY).alias("estimated_fare"),
        F.col("actual_fare").cast(MONEY).alias("actual_fare"),
        F.col("surge_multiplier").cast(MONEY).alias("surge_multiplier"),
        clean_enum("payment_method").alias("payment_method"),
        default_false("is_corporate").alias("is_corporate"),
        F.col("created_at").cast(TS).alias("created_at"),
        F.col("updated_at").cast(TS).alias("updated_at"),
        *more,
    )


def stg_drivers(drivers_raw: DataFrame, keys: Observation | None = None) -> DataFrame:
    """M2: one row per driver, latest ``updated_at``; rating clamped to [1, 5]."""
    d = dedupe_latest(drivers_raw, ["driver_id"], ["updated_at"])
    rating = F.col("rating").cast("double")
    out = _kept(d, keys).select(
        F.col("driver_id").cast("bigint").alias("driver_id"),
        F.col("city_id").cast("bigint").alias("city_id"),
        F.col("vehicle_id").cast("bigint").alias("vehicle_id"),
        F.col("onboarding_date").cast("date").alias("onboarding_date"),
        F.col("created_at").cast(TS).alias("created_at"),
        F.col("updated_at").cast(TS).alias("updated_at"),
        clean_enum("driver_status").alias("driver_status"),
        clamp(rating, 1, 5).alias("rating"),
    )
    return _require(out, "driver_id", "city_id")


def stg_riders(riders_raw: DataFrame, keys: Observation | None = None) -> DataFrame:
    """M3: one row per rider, latest ``created_at``."""
    d = dedupe_latest(riders_raw, ["rider_id"], ["created_at"])
    out = _kept(d, keys).select(
        F.col("rider_id").cast("bigint").alias("rider_id"),
        F.col("signup_date").cast("date").alias("signup_date"),
        F.col("created_at").cast(TS).alias("created_at"),
        blank_default("country", "unknown").alias("country_code"),
        trim_ws("referral_code").alias("referral_code"),
    )
    return _require(out, "rider_id", "signup_date")


def stg_payments(payments_raw: DataFrame, keys: Observation | None = None) -> DataFrame:
    """M4: one row per payment, latest ``created_at`` then highest ``ingest_seq``."""
    tiebreak = ["ingest_seq"] if "ingest_seq" in payments_raw.columns else None
    d = dedupe_latest(payments_raw, ["payment_id"], ["created_at"], tiebreak)
    amount = F.col("amount").cast(MONEY)
    fee = F.col("fee").cast(MONEY)
    out = _kept(d, keys).select(
        F.col("payment_id").cast("bigint").alias("payment_id"),
        F.col("trip_id").cast("bigint").alias("trip_id"),
        whitelist("payment_status", PAYMENT_STATUSES).alias("payment_status"),
        whitelist("payment_provider", PAYMENT_PROVIDERS).alias("payment_provider"),
        floor_zero(amount).cast(MONEY).alias("amount"),
        floor_zero(fee, null_to=0).cast(MONEY).alias("fee"),
        blank_default("currency", "UNKNOWN").alias("currency"),
        F.col("created_at").cast(TS).alias("created_at"),
    )
    return _require(out, "payment_id", "trip_id")


def stg_cities(cities_raw: DataFrame, keys: Observation | None = None) -> DataFrame:
    """M5: one row per city, latest ``launch_date``; blank names -> 'unknown'."""
    d = dedupe_latest(cities_raw, ["city_id"], ["launch_date"])
    out = _kept(d, keys).select(
        F.col("city_id").cast("bigint").alias("city_id"),
        blank_default("city_name", "unknown", upper=False).alias("city_name"),
        blank_default("country", "unknown").alias("country_code"),
        F.col("launch_date").cast("date").alias("launch_date"),
    )
    return _require(out, "city_id")


def stg_status_events(events_raw: DataFrame, keys: Observation | None = None) -> DataFrame:
    """M6: one row per event; status whitelisted, unrecognised rows dropped."""
    d = dedupe_latest(events_raw.filter(F.col("driver_id").isNotNull()),
                      ["event_id"], ["event_timestamp"])
    out = _kept(d, keys).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("driver_id").cast("bigint").alias("driver_id"),
        whitelist("status", DRIVER_EVENT_STATUSES, default="unknown").alias("driver_status"),
        F.col("event_timestamp").cast(TS).alias("event_timestamp"),
    )
    return _require(out, "event_id", "driver_id").filter(F.col("driver_status") != "unknown")
