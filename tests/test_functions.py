"""Unit tests of the Column functions on hand rows: nulls, blanks, band edges, dates."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from fareflow.functions import bands
from fareflow.functions.clean import blank_default, clamp, clean_enum, floor_zero, whitelist
from fareflow.functions.dates import days_between, elapsed, months_crossed, week_sunday
from fareflow.functions.keys import surrogate_key
from fareflow.functions.rates import exact_avg, safe_pct


def _one(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_enum_strips_all_whitespace(spark):
    assert _one(spark, clean_enum("c"), "\t Completed \n", "c string") == "completed"


def test_whitelist_nulls_and_default(spark):
    df = spark.createDataFrame([(" FAILED",), ("pending",), (None,)], "c string")
    out = [r[0] for r in df.select(whitelist("c", ["success", "failed"])).collect()]
    assert out == ["failed", None, None]
    out = [r[0] for r in df.select(whitelist("c", ["failed"], default="unknown")).collect()]
    assert out == ["failed", "unknown", "unknown"]


def test_blank_default(spark):
    df = spark.createDataFrame([(" gb ",), ("  ",), (None,), ("\t",)], "c string")
    assert [r[0] for r in df.select(blank_default("c", "unknown")).collect()] == ["GB", "unknown", "unknown", "unknown"]
    assert _one(spark, blank_default("c", "unknown", upper=False), " Paris ", "c string") == "Paris"


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (3.3,), (5.0,), (7.0,), (None,)], "c double")
    assert [r[0] for r in df.select(clamp(F.col("c"), 1, 5)).collect()] == [1.0, 1.0, 3.3, 5.0, 5.0, None]


def test_floor_zero(spark):
    df = spark.createDataFrame([(Decimal("-1"),), (Decimal("2.5"),), (None,)], "c decimal(28,9)")
    assert [r[0] for r in df.select(floor_zero(F.col("c"))).collect()] == [0, Decimal("2.5"), None]
    assert [r[0] for r in df.select(floor_zero(F.col("c"), null_to=0)).collect()] == [0, Decimal("2.5"), 0]


def test_surge_band_edges_and_null(spark):
    vals = [(Decimal(x),) if x is not None else (None,) for x in ["1.0", "1.5", "1.51", "2.0", "3.0", "3.01", None]]
    df = spark.createDataFrame(vals, "c decimal(28,9)")
    got = [r[0] for r in df.select(bands.surge_band("c")).collect()]
    assert got == ["No Surge", "Low Surge", "Medium Surge", "Medium Surge", "High Surge", "Extreme Surge",
                   "Extreme Surge"]
    got = [r[0] for r in df.select(bands.extreme_surge("c")).collect()]
    assert got == [False] * 7


def test_rating_tier_ltv_edges(spark):
    df = spark.createDataFrame([(4.5,), (4.49,), (4.0,), (3.0,), (2.9,), (None,)], "c double")
    assert [r[0] for r in df.select(bands.rating_category("c")).collect()] == [
        "Top Rated", "Good", "Good", "Average", "Needs Improvement", "No Ratings"]
    df = spark.createDataFrame([(1000,), (999,), (500,), (100,), (99,), (None,)], "c bigint")
    assert [r[0] for r in df.select(bands.driver_tier("c")).collect()] == [
        "Platinum", "Gold", "Gold", "Silver", "Bronze", "Bronze"]
    df = spark.createDataFrame([(Decimal(1000), 1), (Decimal(50), 1), (None, None)], "r decimal(28,9), f int")
    assert [r[0] for r in df.select(bands.ltv_segment("r", "f")).collect()] == [
        "High Value", "New", "Signed Up - No Trips"]


def test_driver_health_and_rider_status(spark):
    as_of = dt.date(2001, 8, 2)
    rows = [("inactive", None), ("suspended", None), ("active", None),
            ("active", dt.datetime(2001, 7, 2, 23, 59)), ("active", dt.datetime(2001, 7, 3, 0, 0)),
            ("active", dt.datetime(2001, 7, 26, 0, 0))]
    df = spark.createDataFrame(rows, "s string, t timestamp")
    got = [r[0] for r in df.select(bands.driver_health("s", "t", as_of)).collect()]
    assert got == ["Churned", "Suspended", "Never Active", "At Risk", "Recent", "Active"]
    df = spark.createDataFrame([(None,), (dt.datetime(2001, 5, 1),), (dt.datetime(2001, 6, 20),),
                                (dt.datetime(2001, 8, 1),)], "t timestamp")
    got = [r[0] for r in df.select(bands.rider_status("t", "t", as_of)).collect()]
    assert got == ["Inactive", "Churned", "At Risk", "Active"]


def test_fraud_reason_first_match(spark):
    cols = [f for f, _ in bands.FRAUD_REASONS]
    df = spark.createDataFrame([(False, True, True, False, True), (False,) * 5], ", ".join(f"{c} boolean" for c in cols))
    assert [r[0] for r in df.select(bands.fraud_reason()).collect()] == [
        "Failed Payment on Completed Trip", "Multiple Indicators"]


def test_elapsed_whole_units(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0, 0), dt.datetime(2020, 1, 1, 0, 1, 59))],
                               "a timestamp, b timestamp")
    assert df.select(elapsed("MINUTE", "a", "b")).first()[0] == 1
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 12), dt.datetime(2020, 1, 2, 11, 59))], "a timestamp, b timestamp")
    assert df.select(elapsed("DAY", "a", "b")).first()[0] == 0


def test_months_crossed_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31), dt.date(2020, 2, 1))], "a date, b date")
    assert df.select(months_crossed("a", "b"), days_between("a", "b")).first() == (1, 1)


def test_week_sunday_matches_strftime_u(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(0, 800, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(week_sunday("d")).collect()]
    assert got == [int(d.strftime("%U")) for d in days]


def test_surrogate_key_handles_null(spark):
    df = spark.createDataFrame([(1, None)], "a bigint, b bigint")
    import hashlib
    expect = hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()
    assert df.select(surrogate_key("a", "b")).first()[0] == expect
    assert df.select(surrogate_key("a")).first()[0] == hashlib.md5(b"1").hexdigest()


def test_safe_pct_and_exact_avg(spark):
    df = spark.createDataFrame([(1, Decimal("1.5")), (0, None), (0, Decimal("2"))], "f int, a decimal(28,9)")
    row = df.agg(safe_pct(F.sum("f"), F.count(F.lit(1))).alias("p"), exact_avg("a").alias("m")).first()
    assert row["p"] == 33.33 and row["m"] == 1.75
    empty = spark.createDataFrame([(0, None)], "f int, a decimal(28,9)")
    assert empty.agg(exact_avg("a")).first()[0] is None
    assert empty.agg(safe_pct(F.sum("f"), F.sum("f"))).first()[0] is None
