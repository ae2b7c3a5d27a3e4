"""Raw source contracts (the six landing tables) and their readers.

Every raw table is read with an explicit schema (never ``inferSchema``); the
types below are what the loader delivers, staging then casts to the model
types.  Column lists follow the source contract of the six tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = T.DecimalType(28, 9)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "trips_raw": T.StructType([
        T.StructField("trip_id", T.LongType()),
        T.StructField("rider_id", T.LongType()),
        T.StructField("driver_id", T.LongType()),
        T.StructField("vehicle_id", T.LongType()),
        T.StructField("city_id", T.LongType()),
        T.StructField("requested_at", T.TimestampNTZType()),
        T.StructField("pickup_at", T.TimestampNTZType()),
        T.StructField("dropoff_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("estimated_fare", MONEY),
        T.StructField("actual_fare", MONEY),
        T.StructField("surge_multiplier", MONEY),
        T.StructField("payment_method", T.StringType()),
        T.StructField("is_corporate", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]),
    "drivers_raw": T.StructType([
        T.StructField("driver_id", T.LongType()),
        T.StructField("onboarding_date", T.TimestampNTZType()),
        T.StructField("driver_status", T.StringType()),
        T.StructField("city_id", T.LongType()),
        T.StructField("vehicle_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]),
    "riders_raw": T.StructType([
        T.StructField("rider_id", T.LongType()),
        T.StructField("signup_date", T.TimestampNTZType()),
        T.StructField("country", T.StringType()),
        T.StructField("referral_code", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]),
    "payments_raw": T.StructType([
        T.StructField("payment_id", T.LongType()),
        T.StructField("trip_id", T.LongType()),
        T.StructField("payment_status", T.StringType()),
        T.StructField("payment_provider", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("fee", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        # loader sequence number: the dedup tie-break when created_at ties
        T.StructField("ingest_seq", T.LongType()),
    ]),
    "cities_raw": T.StructType([
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("launch_date", T.TimestampNTZType()),
    ]),
    "driver_status_events_raw": T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("driver_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
    ]),
}

RAW_TABLES = tuple(RAW_SCHEMAS)

# Freshness contract per raw table: (loaded_at column, warn after, error after),
# durations in minutes.  Fixed values of the source contract.
FRESHNESS = {
    "trips_raw": ("created_at", 60, 120),
    "drivers_raw": ("updated_at", 24 * 60, 48 * 60),
    "riders_raw": ("created_at", 24 * 60, 48 * 60),
    "payments_raw": ("created_at", 60, 180),
    "cities_raw": ("created_at", 168 * 60, 720 * 60),
    "driver_status_events_raw": ("event_timestamp", 30, 60),
}
DEFAULT_FRESHNESS = (None, 2 * 60, 4 * 60)


def read_raw(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan one landing table with its declared schema.

    Column pruning and filter pushdown reach the scan because the schema is
    explicit and nothing is computed before the first projection.
    """
    schema = RAW_SCHEMAS[table]
    return spark.read.schema(schema).format(fmt).load(path)
