"""Business classifications and measures.

Each band is an ordered CASE: the first matching rule wins, exactly as the
business rules are stated.  Thresholds and labels are fixed values of the
business definitions and are kept together below.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareflow.functions.clean import _col
from fareflow.functions.dates import elapsed

# ---- fixed values of the business rules --------------------------------------
# surge band: upper bounds (inclusive) in order, then the catch-all label
SURGE_BANDS = [(1.0, "No Surge"), (1.5, "Low Surge"), (2.0, "Medium Surge"), (3.0, "High Surge")]
SURGE_ELSE = "Extreme Surge"
EXTREME_SURGE_ABOVE = 10
AMOUNT_MISMATCH_ABOVE = 1
# driver rating categories: lower bounds (inclusive) in order
RATING_BANDS = [(4.5, "Top Rated"), (4.0, "Good"), (3.0, "Average")]
RATING_PRESENT = "Needs Improvement"
RATING_MISSING = "No Ratings"
# driver tier by lifetime completed trips: lower bounds (inclusive)
DRIVER_TIERS = [(1000, "Platinum"), (500, "Gold"), (100, "Silver")]
DRIVER_TIER_ELSE = "Bronze"
# rider lifetime value segments: lower bounds (inclusive) on revenue
LTV_BANDS = [(1000, "High Value"), (500, "Medium Value"), (100, "Low Value")]
LTV_NO_TRIPS = "Signed Up - No Trips"
LTV_ELSE = "New"
# driver health: days since last trip
DRIVER_AT_RISK_DAYS = 30
DRIVER_RECENT_DAYS = 7
# rider status: days since last trip
RIDER_CHURNED_DAYS = 90
RIDER_AT_RISK_DAYS = 30
UK_RIDER_CODES = ["UK", "GB", "UNITED KINGDOM"]
UK_CITY_CODES = ["UK", "GB"]
# fraud reasons, first match wins
FRAUD_REASONS = [
    ("fraud_duplicate_payments", "Duplicate Payment"),
    ("fraud_failed_payment", "Failed Payment on Completed Trip"),
    ("fraud_extreme_surge", "Extreme Surge (>10x)"),
    ("fraud_no_payment", "Completed Trip - No Payment"),
    ("fraud_amount_mismatch", "Amount Mismatch"),
]
FRAUD_REASON_ELSE = "Multiple Indicators"
# -------------------------------------------------------------------------------


def _ts(as_of) -> Column:
    """``as_of`` (date) as a timestamp at 00:00 of the session time zone (UTC)."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, dt.datetime):
        return F.lit(as_of).cast("timestamp")
    return F.lit(dt.datetime(as_of.year, as_of.month, as_of.day)).cast("timestamp")


def surge_band(c) -> Column:
    """Surge impact category; NULL falls through to the catch-all."""
    v = _col(c)
    expr = None
    for bound, label in SURGE_BANDS:
        expr = (F.when(v <= bound, label) if expr is None else expr.when(v <= bound, label))
    return expr.otherwise(SURGE_ELSE)


def extreme_surge(c) -> Column:
    """Surge above 10x; NULL is not extreme."""
    return F.coalesce(_col(c) > EXTREME_SURGE_ABOVE, F.lit(False))


def net_revenue(fare, fee) -> Column:
    """coalesce(fare, 0) - coalesce(fee, 0)."""
    return F.coalesce(_col(fare), F.lit(0)) - F.coalesce(_col(fee), F.lit(0))


def trip_duration(status, start, end) -> Column:
    """T4: whole minutes pickup -> dropoff, only for completed trips."""
    s, e = _col(start), _col(end)
    return F.when((_col(status) == "completed") & s.isNotNull() & e.isNotNull(),
                  elapsed("MINUTE", s, e))


def trip_type(is_corporate) -> Column:
    """T5: 'Corporate' when the flag is TRUE, else 'Personal'."""
    return F.when(_col(is_corporate) == F.lit(True), "Corporate").otherwise("Personal")


def driver_health(status, last_trip, as_of) -> Column:
    """Churn tracking from driver status and last trip time."""
    st, last, now = _col(status), _col(last_trip), _ts(as_of)
    return (F.when(st == "inactive", "Churned")
            .when(st == "suspended", "Suspended")
            .when(last.isNull(), "Never Active")
            .when(last < now - F.expr(f"INTERVAL {DRIVER_AT_RISK_DAYS} DAYS"), "At Risk")
            .when(last < now - F.expr(f"INTERVAL {DRIVER_RECENT_DAYS} DAYS"), "Recent")
            .otherwise("Active"))


def rating_category(c) -> Column:
    """T13."""
    v = _col(c)
    expr = None
    for bound, label in RATING_BANDS:
        expr = F.when(v >= bound, label) if expr is None else expr.when(v >= bound, label)
    return expr.when(v.isNotNull(), RATING_PRESENT).otherwise(RATING_MISSING)


def driver_tier(lifetime_trips) -> Column:
    """Tier by lifetime trips (NULL counts as 0)."""
    v = F.coalesce(_col(lifetime_trips), F.lit(0))
    expr = None
    for bound, label in DRIVER_TIERS:
        expr = F.when(v >= bound, label) if expr is None else expr.when(v >= bound, label)
    return expr.otherwise(DRIVER_TIER_ELSE)


def ltv_segment(revenue, first_trip) -> Column:
    """Value segment from lifetime revenue; riders without trips apart."""
    v = F.coalesce(_col(revenue), F.lit(0))
    expr = None
    for bound, label in LTV_BANDS:
        expr = F.when(v >= bound, label) if expr is None else expr.when(v >= bound, label)
    return expr.when(_col(first_trip).isNull(), LTV_NO_TRIPS).otherwise(LTV_ELSE)


def rider_status(first_trip, last_trip, as_of) -> Column:
    """T16."""
    last, now = _col(last_trip), _ts(as_of)
    return (F.when(_col(first_trip).isNull(), "Inactive")
            .when(last < now - F.expr(f"INTERVAL {RIDER_CHURNED_DAYS} DAYS"), "Churned")
            .when(last < now - F.expr(f"INTERVAL {RIDER_AT_RISK_DAYS} DAYS"), "At Risk")
            .otherwise("Active"))


def region(country_code) -> Column:
    """UK rider or International."""
    return F.when(F.upper(_col(country_code)).isin(UK_RIDER_CODES), "UK").otherwise("International")


def market_type(country_code) -> Column:
    """Domestic (UK/GB) or International city."""
    return F.when(_col(country_code).isin(UK_CITY_CODES), "Domestic").otherwise("International")


def referral_effectiveness(referral_code, lifetime_trips) -> Column:
    """Did a referred rider take a trip?"""
    code = _col(referral_code)
    has_code = code.isNotNull() & (code != "")
    return (F.when(has_code & (_col(lifetime_trips) > 0), "Successful Referral")
            .when(has_code, "Unused Referral")
            .otherwise("No Referral"))


def status_flag(status, value: str) -> Column:
    """1 when ``status == value`` else 0 (NULL -> 0), as bigint."""
    return F.when(_col(status) == value, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def fee_percentage(fee, amount) -> Column:
    """Fee / amount * 100 (double), only when amount > 0 and fee known."""
    f, a = _col(fee), _col(amount)
    return F.when((a > 0) & f.isNotNull(), f.cast("double") / a.cast("double") * F.lit(100.0))


def amount_difference(amount, fare) -> Column:
    """Amount - fare when both are known (NULL otherwise)."""
    a, f = _col(amount), _col(fare)
    return F.when(f.isNotNull() & a.isNotNull(), a - f)


def is_weekend(d) -> Column:
    """Sunday (1) or Saturday (7)."""
    return F.dayofweek(_col(d)).isin(1, 7)


def fraud_reason() -> Column:
    """The first fraud rule that fired, in rule order."""
    expr = None
    for flag, label in FRAUD_REASONS:
        c = F.col(flag)
        expr = F.when(c, label) if expr is None else expr.when(c, label)
    return expr.otherwise(FRAUD_REASON_ELSE)
