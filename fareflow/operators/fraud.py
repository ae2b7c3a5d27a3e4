"""Payment fraud indicators (T6-T10) and the one-row-per-trip collapse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.bands import AMOUNT_MISMATCH_ABOVE, extreme_surge

FRAUD_FLAGS = ["fraud_duplicate_payments", "fraud_failed_payment", "fraud_extreme_surge",
               "fraud_no_payment", "fraud_amount_mismatch"]


def duplicate_payments(payments: DataFrame, key: str = "trip_id") -> DataFrame:
    """Key, payment_attempts, has_duplicate_payments (more than one payment).

    A hash aggregate with map-side partial counts: a key with a huge number
    of payments is pre-counted in every map task before the shuffle.
    """
    return (payments.groupBy(key)
            .agg(F.count(F.lit(1)).alias("payment_attempts"))
            .withColumn("has_duplicate_payments", F.col("payment_attempts") > 1))


def _completed() -> Column:
    return F.col("trip_status") == "completed"


def fraud_flags(df: DataFrame) -> DataFrame:
    """T7-T10 on trip x payment rows.

    Needs trip_status, payment_status, surge_multiplier, payment_id,
    payment_amount, actual_fare and has_duplicate_payments.  Every flag is a
    definite boolean (a NULL test counts as not fired).
    """
    mismatch = (_completed() & F.col("payment_amount").isNotNull() & F.col("actual_fare").isNotNull()
                & (F.abs(F.col("payment_amount") - F.col("actual_fare")) > AMOUNT_MISMATCH_ABOVE))
    flags = {
        "fraud_duplicate_payments": F.coalesce(F.col("has_duplicate_payments"), F.lit(False)),
        "fraud_failed_payment": F.coalesce(_completed() & (F.col("payment_status") == "failed"), F.lit(False)),
        "fraud_extreme_surge": extreme_surge("surge_multiplier"),
        "fraud_no_payment": F.coalesce(_completed() & F.col("payment_id").isNull(), F.lit(False)),
        "fraud_amount_mismatch": F.coalesce(mismatch, F.lit(False)),
    }
    out = df
    for name, expr in flags.items():
        out = out.withColumn(name, expr)
    any_flag = None
    for name in FRAUD_FLAGS:
        any_flag = F.col(name) if any_flag is None else any_flag | F.col(name)
    return out.withColumn("is_fraud_flag", any_flag)


def payment_summary(payments: DataFrame, key: str = "trip_id") -> DataFrame:
    """One row per trip with the payment facts the trip fact needs.

    Per trip over its payments: attempts, whether any failed, the amount
    range (the mismatch test is "some amount differs from the fare by more
    than 1", i.e. max - fare > 1 or fare - min > 1) and the chosen payment:
    success first, then latest ``created_at``, then highest ``payment_id``.
    Aggregated with partial (map-side) aggregation, so a trip with a huge
    number of payments never reaches one task as raw rows.
    """
    order = F.struct(F.when(F.col("payment_status") == "success", 1).otherwise(0).alias("ok"),
                     F.col("created_at").alias("ts"), F.col("payment_id").alias("pid"))
    return (payments.groupBy(key)
            .agg(F.count(F.lit(1)).alias("payment_attempts"),
                 F.bool_or(F.col("payment_status") == "failed").alias("any_failed"),
                 F.min("amount").alias("min_amount"),
                 F.max("amount").alias("max_amount"),
                 F.max_by(F.col("fee"), order).alias("chosen_fee"))
            .withColumn("has_duplicate_payments", F.col("payment_attempts") > 1))


def trip_fraud_flags(df: DataFrame) -> DataFrame:
    """T6-T10 at trip grain from ``payment_summary`` columns (NULL = no payment)."""
    completed = _completed()
    mismatch = completed & F.col("actual_fare").isNotNull() & (
        (F.col("max_amount") - F.col("actual_fare") > AMOUNT_MISMATCH_ABOVE)
        | (F.col("actual_fare") - F.col("min_amount") > AMOUNT_MISMATCH_ABOVE))
    flags = {
        "fraud_duplicate_payments": F.coalesce(F.col("has_duplicate_payments"), F.lit(False)),
        "fraud_failed_payment": F.coalesce(completed & F.col("any_failed"), F.lit(False)),
        "fraud_extreme_surge": extreme_surge("surge_multiplier"),
        "fraud_no_payment": F.coalesce(completed & F.col("payment_attempts").isNull(), F.lit(False)),
        "fraud_amount_mismatch": F.coalesce(mismatch, F.lit(False)),
    }
    out = df
    for name, expr in flags.items():
        out = out.withColumn(name, expr)
    any_flag = None
    for name in FRAUD_FLAGS:
        any_flag = F.col(name) if any_flag is None else any_flag | F.col(name)
    return out.withColumn("is_fraud_flag", any_flag)


# name used by the operator inventory
flag_duplicates = duplicate_payments
