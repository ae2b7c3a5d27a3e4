"""The declared data-quality suite of the six sources and the models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.operators import quality as Q
from fareflow.sources.raw import DEFAULT_FRESHNESS, FRESHNESS

# Declared column tests of the source contract (fixed values).
NOT_NULL = {
    "trips_raw": ["trip_id", "rider_id", "driver_id", "vehicle_id", "city_id", "requested_at", "status",
                  "estimated_fare", "surge_multiplier", "payment_method", "is_corporate", "created_at",
                  "updated_at"],
    "drivers_raw": ["driver_id", "onboarding_date", "driver_status", "city_id", "vehicle_id", "rating",
                    "created_at", "updated_at"],
    "riders_raw": ["rider_id", "signup_date", "country", "created_at"],
    "payments_raw": ["payment_id", "trip_id", "payment_status", "payment_provider", "amount", "currency",
                     "created_at"],
    "cities_raw": ["city_id", "city_name", "country", "launch_date"],
    "driver_status_events_raw": ["event_id", "driver_id", "status", "event_timestamp"],
}
UNIQUE = {"trips_raw": "trip_id", "drivers_raw": "driver_id", "riders_raw": "rider_id",
          "payments_raw": "payment_id", "cities_raw": "city_id", "driver_status_events_raw": "event_id"}
ACCEPTED = [("trips_raw", "is_corporate", [True, False]),
            ("driver_status_events_raw", "status", ["online", "offline"])]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_not_null(m) -> DataFrame:
    return _union([Q.check_not_null(m.raw[t], t, cols) for t, cols in NOT_NULL.items()])


def dq_unique(m) -> DataFrame:
    """Q2 on the raw keys, and on the fact's merge key (the reports count trips by it)."""
    return _union([*(Q.check_unique(m.raw[t], t, k) for t, k in UNIQUE.items()),
                   Q.check_unique(m.lean().fact_trips, "fact_trips", "trip_sk")])


def dq_accepted(m) -> DataFrame:
    return _union([Q.check_accepted(m.raw[t], t, c, v) for t, c, v in ACCEPTED])


def dq_relationships(m) -> DataFrame:
    """Q4: references between staged models and from the fact to its dimensions."""
    lean = m.lean()
    return _union([
        Q.check_relationships(m.stg_trips, "stg_trips", [("driver_id", m.stg_drivers, "driver_id"), ("rider_id", m.stg_riders, "rider_id"),
                                                         ("city_id", m.stg_cities, "city_id")]),
        Q.check_relationship(lean.stg_payments, "stg_payments", "trip_id", m.stg_trips, "trip_id"),
        Q.check_relationships(lean.fact_trips, "fact_trips", [("driver_sk", m.dim_drivers, "driver_sk"), ("rider_sk", m.dim_riders, "rider_sk"),
                                                              ("city_sk", m.dim_cities, "city_sk")]),
    ])


def dq_custom(m) -> DataFrame:
    """Q5: the three business checks, as violating rows (check, trip_id, payment_id)."""
    td = m.int_trip_details
    neg = td.filter(F.col("actual_fare") < 0).select(
        F.lit("no_negative_fare").alias("check"), "trip_id", "payment_id")
    dur = td.filter((F.col("trip_status") == "completed") & (F.col("trip_duration_minutes") <= 0)).select(
        F.lit("completed_duration_positive").alias("check"), "trip_id", "payment_id")
    t = m.stg_trips.filter(F.col("trip_status") == "completed").select("trip_id")
    p = m.stg_payments.select("trip_id", "payment_id", "payment_status")
    unpaid = (t.join(p, "trip_id", "left")
              .filter(~F.col("payment_status").eqNullSafe("success"))
              .select(F.lit("completed_has_successful_payment").alias("check"), "trip_id", "payment_id"))
    return neg.unionByName(dur).unionByName(unpaid)


CUSTOM_CHECKS = ("no_negative_fare", "completed_duration_positive", "completed_has_successful_payment")


def dq_custom_results(m) -> DataFrame:
    """Q5 as rule results: the violating rows of each business check, counted."""
    counts = dq_custom(m).groupBy("check").agg(F.count(F.lit(1)).alias("_v"))
    rules = m.spark.createDataFrame([(c,) for c in CUSTOM_CHECKS], "check string")
    v = F.coalesce("_v", F.lit(0)).cast("bigint")
    return rules.join(counts, "check", "left").select(
        F.lit("trips").alias("table"), F.col("check").alias("rule"), F.lit("*").alias("column"), v.alias("violations"),
        F.when(v == 0, "pass").otherwise("fail").alias("status"))


def dq_freshness(m) -> DataFrame:
    as_of = m.config.as_of_ts
    parts = []
    for t, df in m.raw.items():
        col, warn, err = FRESHNESS.get(t, DEFAULT_FRESHNESS)
        parts.append(Q.freshness(df, t, col, warn, err, as_of))
    return _union(parts)


def dq_summary(m) -> DataFrame:
    """Every rule result of the suite in one table."""
    custom = dq_custom_results(m)  # first: it keeps the payments whole, and the others then read the kept copy
    return _union([dq_not_null(m), dq_unique(m), dq_accepted(m), dq_relationships(m), custom])


def raw_rules(table: str) -> list:
    """Q1 and Q3 of a raw table, and the rows with a key (rule ``keyed``, for the uniqueness check)."""
    return [*Q.not_null_rules(NOT_NULL[table]), *(Q.accepted_rule(c, v) for t, c, v in ACCEPTED if t == table),
            ("keyed", UNIQUE[table], F.col(UNIQUE[table]).isNotNull())]


def trip_rules() -> list:
    """Q5 on the trip x payment rows."""
    done = F.col("trip_status") == "completed"
    bad = [F.col("actual_fare") < 0, done & (F.col("trip_duration_minutes") <= 0), done & ~F.col("payment_status").eqNullSafe("success")]
    return [(rule, "*", b) for rule, b in zip(CUSTOM_CHECKS, bad, strict=True)]


def measured_summary(m, measures: Q.Measures, keys: dict[str, int]) -> DataFrame:
    """E3 from a run's own measures: Q1, Q3 and Q5 need no further pass; a raw key is unique if the run kept
    as many rows as it read (``keys``: distinct keys of each raw table), else Q2 counts its repeated
    values; Q4 and the fact's key are checked on the stored tables."""
    rows = measures.rows(m.spark, aside="keyed")
    passed = [t for t, n in keys.items() if measures.measured(t, "keyed") == n]
    unique = m.spark.createDataFrame([(t, "unique", UNIQUE[t], 0, "pass") for t in passed], rows.schema)
    repeated = [Q.check_unique(m.raw[t], t, k) for t, k in UNIQUE.items() if t not in passed]
    return _union([rows, unique, *repeated, Q.check_unique(m.fact_trips, "fact_trips", "trip_sk"), dq_relationships(m)])


def dq_measured(m) -> DataFrame:
    """Q1-Q5 measured by a full run while it stores its tables (the rows of ``dq_summary``)."""
    from fareflow.operators.incremental import shared_table_path
    from fareflow.plans.pipeline import Models, materialize

    run = Models(m.spark, dict(m.raw), m.config)
    return materialize(run, shared_table_path(m.spark, "measured-run"), measure=True)[1]


# Casts staging applies to each raw table (the typed contract).
STAGING_CASTS = {
    "trips_raw": {"trip_id": "bigint", "rider_id": "bigint", "driver_id": "bigint", "city_id": "bigint",
                  "requested_at": "timestamp", "pickup_at": "timestamp", "dropoff_at": "timestamp",
                  "estimated_fare": "decimal(28,9)", "actual_fare": "decimal(28,9)",
                  "surge_multiplier": "decimal(28,9)", "is_corporate": "boolean",
                  "created_at": "timestamp", "updated_at": "timestamp"},
    "drivers_raw": {"driver_id": "bigint", "city_id": "bigint", "vehicle_id": "bigint", "onboarding_date": "date",
                    "created_at": "timestamp", "updated_at": "timestamp", "rating": "double"},
    "riders_raw": {"rider_id": "bigint", "signup_date": "date", "created_at": "timestamp"},
    "payments_raw": {"payment_id": "bigint", "trip_id": "bigint", "amount": "decimal(28,9)",
                     "fee": "decimal(28,9)", "created_at": "timestamp"},
    "cities_raw": {"city_id": "bigint", "launch_date": "date"},
    "driver_status_events_raw": {"event_id": "bigint", "driver_id": "bigint", "event_timestamp": "timestamp"},
}


def quarantined_rows(m) -> DataFrame:
    """Q6: raw rows that staging's casts would reject: table, key, failing columns and the row as JSON."""
    parts = []
    for t, casts in STAGING_CASTS.items():
        _, bad = Q.quarantine(m.raw[t], casts, UNIQUE[t])
        row = F.to_json(F.struct(*[F.col(c) for c in m.raw[t].columns]))
        parts.append(bad.select(F.lit(t).alias("table"), "row_key", "failed_columns", row.alias("row")))
    return _union(parts)


def dq_quarantine(m) -> DataFrame:
    """Q6: the rejected rows of the landing tables without their contents."""
    return quarantined_rows(m).drop("row")


def dq_quarantine_text(m) -> DataFrame:
    """Q6 on a landing table of text with malformed values: some amounts and timestamps of the payments."""
    raw = m.raw["payments_raw"]
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    text = (text.withColumn("amount", F.when(F.col("payment_id").cast("bigint") % 50 == 0, "n/a").otherwise(F.col("amount")))
            .withColumn("created_at", F.when(F.col("payment_id").cast("bigint") % 75 == 0, "soon").otherwise(F.col("created_at"))))
    _, bad = Q.quarantine(text, STAGING_CASTS["payments_raw"], "payment_id")
    return bad.select(F.lit("payments_raw").alias("table"), "row_key", "failed_columns")
