"""One query per operator of the inventory, each over the whole derived tables.

Every function takes the model graph (``Models``) and returns a DataFrame
exercising one operator on real rows, so the operator can be checked on its
own against the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions import bands
from fareflow.functions.clean import blank_default, clamp, floor_zero, whitelist
from fareflow.functions.dates import days_between, elapsed, months_crossed
from fareflow.functions.keys import surrogate_key
from fareflow.operators.distinct import distinct_sketches, exact_counts, merged_counts, standard_error
from fareflow.operators.fraud import duplicate_payments
from fareflow.operators.incremental import shared_table_path
from fareflow.operators.ranking import global_rank, rank_within, top_n_per
from fareflow.operators.sessions import next_event, pair_sessions
from fareflow.operators.spine import spine_between
from fareflow.plans import intermediate, marts
from fareflow.plans.staging import DRIVER_EVENT_STATUSES, PAYMENT_PROVIDERS, PAYMENT_STATUSES
from fareflow.sources.sinks import write_bucketed, write_table


def enum_whitelist(m) -> DataFrame:
    """C3/C4 on every raw payment and status event row."""
    p = m.raw["payments_raw"].select(
        F.lit("payment").alias("source"), F.col("payment_id").alias("id"), F.col("ingest_seq").alias("seq"),
        whitelist("payment_status", PAYMENT_STATUSES).alias("value"),
        whitelist("payment_provider", PAYMENT_PROVIDERS).alias("value2"))
    e = m.raw["driver_status_events_raw"].select(
        F.lit("event").alias("source"), F.col("event_id").alias("id"), F.lit(0).cast("bigint").alias("seq"),
        whitelist("status", DRIVER_EVENT_STATUSES, default="unknown").alias("value"),
        F.lit(None).cast("string").alias("value2"))
    return p.unionByName(e)


def blank_default_q(m) -> DataFrame:
    """C5 on raw riders (country), cities (country, name) and payments (currency)."""
    r = m.raw["riders_raw"].select(F.lit("rider").alias("source"), F.col("rider_id").alias("id"),
                                   blank_default("country", "unknown").alias("value"))
    c = m.raw["cities_raw"].select(F.lit("city").alias("source"), F.col("city_id").alias("id"),
                                   blank_default("country", "unknown").alias("value"))
    n = m.raw["cities_raw"].select(F.lit("city_name").alias("source"), F.col("city_id").alias("id"),
                                   blank_default("city_name", "unknown", upper=False).alias("value"))
    p = m.raw["payments_raw"].select(F.lit("payment").alias("source"), F.col("payment_id").alias("id"),
                                     blank_default("currency", "UNKNOWN").alias("value"))
    return r.unionByName(c).unionByName(n).unionByName(p)


def clamp_rating(m) -> DataFrame:
    """C6 on every raw driver row."""
    return m.raw["drivers_raw"].select("driver_id", clamp(F.col("rating"), 1, 5).alias("rating"))


def floor_negative(m) -> DataFrame:
    """C7 on every raw payment row (amount keeps NULL, fee NULL -> 0)."""
    return m.raw["payments_raw"].select(
        "payment_id", "ingest_seq",
        floor_zero(F.col("amount")).cast("decimal(28,9)").alias("amount"),
        floor_zero(F.col("fee"), null_to=0).cast("decimal(28,9)").alias("fee"))


def trip_bands(m) -> DataFrame:
    """T1-T5 on every staged trip."""
    t = m.stg_trips
    return t.select(
        "trip_id",
        bands.surge_band("surge_multiplier").alias("surge_band"),
        bands.extreme_surge("surge_multiplier").alias("extreme_surge"),
        bands.trip_duration("trip_status", "pickup_at", "dropoff_at").alias("trip_duration_minutes"),
        bands.trip_type("is_corporate").alias("trip_type"))


def net_revenue_q(m) -> DataFrame:
    """T3 over the trip x payment fan-out."""
    return m.int_trip_details.select("trip_id", "payment_id", "net_revenue")


def duplicate_payments_q(m) -> DataFrame:
    """T6 over all staged payments."""
    return duplicate_payments(m.stg_payments)


def _flagged(m, flag: str) -> DataFrame:
    return m.int_trip_details.filter(F.col(flag)).select("trip_id", "payment_id")


def fraud_failed_payment(m) -> DataFrame:
    return _flagged(m, "fraud_failed_payment")


def fraud_no_payment(m) -> DataFrame:
    return _flagged(m, "fraud_no_payment")


def fraud_amount_mismatch(m) -> DataFrame:
    return _flagged(m, "fraud_amount_mismatch")


def fraud_any(m) -> DataFrame:
    return _flagged(m, "is_fraud_flag")


def driver_bands(m) -> DataFrame:
    """T12-T14 per driver."""
    return m.driver_metrics.select("driver_id", "driver_health_status", "rating_category", "driver_tier")


def rider_bands(m) -> DataFrame:
    """T15-T17, T19 per rider."""
    return m.rider_metrics.select("rider_id", "ltv_segment", "rider_status", "region", "referral_effectiveness")


def market_type_q(m) -> DataFrame:
    """T18 per city."""
    return m.stg_cities.select("city_id", bands.market_type("country_code").alias("market_type"))


def payment_rates(m) -> DataFrame:
    """T20-T22, A9, J6 per payment."""
    return m.int_payment_analysis.select("payment_id", "is_successful", "is_failed", "fee_percentage",
                                         "amount_difference", "provider_failure_rate")


def rider_corporate_split(m) -> DataFrame:
    """Conditional sums and counts per rider."""
    return m.rider_trip_stats.select("rider_id", "corporate_trips", "personal_trips",
                                     "corporate_revenue", "personal_revenue")


def lead_next_status(m) -> DataFrame:
    """Next event time and status per driver, over all events."""
    e = m.stg_status_events
    return next_event(e, "driver_id", "event_timestamp", "driver_status", "event_id") \
        .select("event_id", "driver_id", "next_ts", "next_status")


def online_sessions(m) -> DataFrame:
    """Every online event with its paired session end."""
    return pair_sessions(m.stg_status_events)


def driver_city_revenue(m) -> DataFrame:
    """Completed-trip revenue per driver and city over the whole fact."""
    return _driver_city_revenue(m.fact_trips)


def _driver_city_revenue(fact: DataFrame) -> DataFrame:
    f = fact.filter(F.col("trip_status") == "completed")
    return (f.groupBy("driver_sk", "city_sk")
            .agg(F.count("trip_id").alias("trips"), F.sum("gross_revenue").alias("revenue")))


def rank_city(m) -> DataFrame:
    """RANK per city by revenue."""
    return rank_within(driver_city_revenue(m), ["city_sk"], ["revenue"], "city_rank")


def rank_overall(m) -> DataFrame:
    """Global RANK by revenue, computed without a single-partition window."""
    return global_rank(driver_city_revenue(m), "revenue", "overall_rank")


def top10_per_city(m) -> DataFrame:
    """O2: top 10 (with ties) per city."""
    return top_n_per(_driver_city_revenue(m.lean().fact_trips), ["city_sk"], ["revenue"], 10, "city_rank")


def surrogate_keys(m) -> DataFrame:
    """T24 on every staged trip's keys."""
    t = m.stg_trips
    return t.select("trip_id", surrogate_key("trip_id").alias("trip_sk"),
                    surrogate_key("driver_id").alias("driver_sk"),
                    surrogate_key("rider_id").alias("rider_sk"),
                    surrogate_key("city_id").alias("city_sk"),
                    surrogate_key("trip_id", "city_id").alias("trip_city_sk"))


def date_spine_q(m) -> DataFrame:
    """Every day between the first and last payment."""
    return spine_between(m.stg_payments, "created_at")


def date_diffs(m) -> DataFrame:
    """D1-D3 on every staged trip."""
    as_of = m.config.as_of
    t = m.stg_trips
    return t.select(
        "trip_id",
        elapsed("MINUTE", "requested_at", "dropoff_at").alias("minutes_to_dropoff"),
        elapsed("DAY", "requested_at", F.lit(m.config.as_of_ts).cast("timestamp")).alias("days_elapsed"),
        days_between(F.to_date("requested_at"), as_of).alias("days_between"),
        months_crossed(F.to_date("requested_at"), as_of).alias("months_crossed"))


def distinct_sketches_q(m) -> DataFrame:
    """A2: distinct riders a month, exact and from the union of stored daily sketches, with the error.  ``within`` says
    whether the estimate lies within five standard errors."""
    trips = m.stg_trips.select(F.to_date("requested_at").alias("day"), "rider_id")
    sketches = write_table(distinct_sketches(trips, ["day"], "rider_id"), shared_table_path(m.spark, "rider-sketches"))
    month = F.trunc("day", "month").alias("month")
    estimated = merged_counts(sketches.select(month, "rows", "sketch"), ["month"])
    exact = exact_counts(trips.select(month, "rider_id"), ["month"], "rider_id")
    error = (F.col("estimate") - F.col("exact")) / F.col("exact")
    return (exact.join(estimated, "month")
            .select("month", F.col("rows").alias("trips"), "exact", "estimate", error.alias("error"),
                    (F.abs(error) <= 5 * standard_error()).alias("within")))


def distinct_riders(m) -> DataFrame:
    """A2: the exact columns of ``distinct_sketches``, and whether the estimate is as good as stated."""
    return distinct_sketches_q(m).select("month", "trips", "exact", "within")


def bucketed_trip_details(m) -> DataFrame:
    """Trips and payments stored by buckets of ``trip_id``; their joins then shuffle neither."""
    trips, payments = bucketed_trip_tables(m)
    return intermediate.int_trip_details(trips, payments, intermediate.trip_hot_keys(payments))


def bucketed_trip_tables(m, buckets: int = 8) -> tuple[DataFrame, DataFrame]:
    out = []
    for name in ("stg_trips", "stg_payments"):
        path = shared_table_path(m.spark, f"bucketed-{name}")
        out.append(write_bucketed(m[name], f"{name}_{path.rsplit('-', 1)[1]}", path, "trip_id", buckets))
    return tuple(out)


def stored_run(m) -> dict[str, str]:
    """A full run of its own (E1) into the shared folder: views, tables, the merged fact, reports."""
    from fareflow.plans.pipeline import materialize

    return materialize(m.run_of_its_own(), shared_table_path(m.spark, "stored-run"))


def stored_daily_revenue(m) -> DataFrame:
    """The report as a full run stored it, read back in its published order."""
    from fareflow.plans.pipeline import read_report

    return read_report(m.spark, stored_run(m)["daily_revenue"].rsplit("/", 1)[0], "daily_revenue")


def staging_views(m) -> DataFrame:
    """S3: payments per provider and trip status, from the staging views of a full run by their names."""
    stored_run(m)
    return m.spark.sql("""SELECT payment_provider, trip_status, count(*) AS payments, sum(amount) AS amount
                          FROM stg_payments JOIN stg_trips USING (trip_id) GROUP BY payment_provider, trip_status""")


def fraud_reasons(m) -> DataFrame:
    """T11, M19 over all days: every reason occurs, as it does not in the report's last week."""
    return marts.fraud_monitoring(m.fact_trips, m.dim_cities, m.dim_drivers, m.dim_riders, m.config.as_of, 36_500, m.config.broadcast_max_rows)


QUERIES = {
    "enum_whitelist": enum_whitelist,
    "blank_default": blank_default_q,
    "clamp_rating": clamp_rating,
    "floor_negative": floor_negative,
    "trip_bands": trip_bands,
    "net_revenue": net_revenue_q,
    "duplicate_payments": duplicate_payments_q,
    "fraud_failed_payment": fraud_failed_payment,
    "fraud_no_payment": fraud_no_payment,
    "fraud_amount_mismatch": fraud_amount_mismatch,
    "fraud_any": fraud_any,
    "driver_bands": driver_bands,
    "rider_bands": rider_bands,
    "market_type": market_type_q,
    "payment_rates": payment_rates,
    "rider_corporate_split": rider_corporate_split,
    "lead_next_status": lead_next_status,
    "online_sessions": online_sessions,
    "rank_city": rank_city,
    "rank_overall": rank_overall,
    "top10_per_city": top10_per_city,
    "surrogate_keys": surrogate_keys,
    "date_spine": date_spine_q,
    "date_diffs": date_diffs,
    "stored_daily_revenue": stored_daily_revenue,
    "staging_views": staging_views,
    "fraud_reasons": fraud_reasons,
    "distinct_riders": distinct_riders,
    "bucketed_trip_details": bucketed_trip_details,
}


def _register_more() -> None:
    from fareflow.plans import history, quality_checks

    QUERIES.update({
        "dq_not_null": quality_checks.dq_not_null,
        "dq_unique": quality_checks.dq_unique,
        "dq_accepted": quality_checks.dq_accepted,
        "dq_relationships": quality_checks.dq_relationships,
        "dq_custom": quality_checks.dq_custom,
        "freshness": quality_checks.dq_freshness,
        "dq_quarantine": quality_checks.dq_quarantine,
        "dq_summary": quality_checks.dq_summary,
        "dq_measured": quality_checks.dq_measured,
        "incremental_delta": history.incremental_delta,
        "merge_by_key": history.merge_by_key_q,
        "merge_null_date": history.merge_null_date,
        "merge_null_date_keyed": history.merge_null_date_keyed,
        "dq_quarantine_text": quality_checks.dq_quarantine_text,
        "scd2_history": history.scd2_history,
        "scd2_closed_keys": history.scd2_closed_keys,
        "fact_current_dims": history.fact_current_dims,
        "fact_hot_lookup": history.fact_hot_lookup,
        "fact_versions_asof": history.fact_versions_asof,
        "incremental_updates": history.incremental_updates,
    })
    from fareflow.streaming import keyed_sessions, status_stream

    QUERIES.update({
        "stream_dedup": status_stream.stream_dedup,
        "stream_sessions": status_stream.stream_sessions,
        "stream_sessions_distributed": status_stream.stream_sessions_distributed,
        "stream_sessions_keyed": keyed_sessions.stream_sessions_keyed,
        "stream_merge": status_stream.stream_merge,
        "stream_late_payments": status_stream.stream_late_payments,
        "stream_stale_trips": status_stream.stream_stale_trips,
    })


_register_more()


# ---- one query per band, under the names of the build plan -----------------------

def _trip_band(column: str, expr):
    return lambda m: m.stg_trips.select("trip_id", expr().alias(column))


def _per_driver(column: str):
    return lambda m: m.driver_metrics.select("driver_id", column)


def _per_rider(column: str):
    return lambda m: m.rider_metrics.select("rider_id", column)


def _per_payment(column: str):
    return lambda m: m.int_payment_analysis.select("payment_id", column)


QUERIES.update({
    "surge_band": _trip_band("surge_impact_category", lambda: bands.surge_band("surge_multiplier")),
    "trip_duration": _trip_band("trip_duration_minutes",
                                lambda: bands.trip_duration("trip_status", "pickup_at", "dropoff_at")),
    "trip_type": _trip_band("trip_type", lambda: bands.trip_type("is_corporate")),
    "driver_health": _per_driver("driver_health_status"),
    "rating_category": _per_driver("rating_category"),
    "driver_tier": _per_driver("driver_tier"),
    "ltv_segment": _per_rider("ltv_segment"),
    "rider_status": _per_rider("rider_status"),
    "region": _per_rider("region"),
    "referral_effectiveness": _per_rider("referral_effectiveness"),
    "fee_percentage": _per_payment("fee_percentage"),
    "provider_failure_rate": _per_payment("provider_failure_rate"),
})
