"""Stacked lookups: one reading of the facts, hot keys dealt evenly, the rows of plain joins."""

import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareflow.operators.incremental import shared_table_path
from fareflow.operators.joins import Lookup, hot_values, lookup_all
from fareflow.plans import marts
from fareflow.plans.pipeline import Models

SF = "/root/testdata/sf0.001"
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


facts = st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2, 9, None]), st.sampled_from(["a", "a", "b", "z", None]), st.integers(0, 3)),
                 min_size=0, max_size=60)


@SETTINGS
@given(facts, st.sampled_from(["left", "inner"]), st.sampled_from([0, 3, 100]))
def test_lookups_equal_plain_joins(spark, rows, how, bound):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, d bigint, c string, v int")
    drivers = spark.createDataFrame([(k, f"d{k}" if k else None, k) for k in range(4)], "d bigint, name string, rank int")
    cities = spark.createDataFrame([("a", 1.5), ("b", None)], "c string, size double")
    # at a hot share of 1/4 both keys have hot values; nulls match nothing; hot rows may have null attributes
    got = lookup_all(df, [Lookup(drivers, "d", how), Lookup(cities, "c", how)], bound, max_hot=4, min_hot_rows=2)
    want = df.join(drivers, "d", how).join(cities, "c", how).select(*got.columns)
    assert _rows(got) == _rows(want)


def test_hot_values_of_all_keys_in_one_pass(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("a"),
                                  F.when(F.col("id") % 3 > 0, F.lit("x")).alias("b"), F.col("id").alias("c"))
    assert hot_values(df, ["a", "b", "c"], 10, 5) == {"a": [7], "b": ["x"], "c": []}
    assert hot_values(df, ["a", "b"], 10, 600) == {"a": [], "b": ["x"]}
    assert hot_values(df, []) == {}


@pytest.fixture
def shuffled(spark):
    """Joins and their partitions as planned for large dims."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("-1", "false"), strict=True):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


@pytest.fixture(scope="module")
def stored(spark):
    path = shared_table_path(spark, "lookup-fact")
    (spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k1"), (F.col("id") % 7).alias("k2"),
                                (F.col("id") % 11).alias("k3")).write.parquet(path))
    return spark.read.parquet(path)


def test_scans_do_not_grow_with_lookups(spark, stored, shuffled):
    dims = [Lookup(spark.range(50).select(F.col("id").alias(k), F.concat(F.lit(k), "id").alias(f"name_{k}")), k) for k in ("k1", "k2", "k3")]
    for n in (1, 2, 3):
        joined = lookup_all(stored, dims[:n], 0, max_hot=10, min_hot_rows=1)
        plan = _plan(joined)
        assert plan.count("FileScan parquet") == 1
        # the facts' shuffle and the dim's, a lookup
        assert plan.count("Exchange hashpartitioning(") == 2 * n
        assert joined.count() == 20_000


def test_hot_rows_are_dealt_evenly(spark, stored, shuffled):
    """A third of the rows has one key: in the lookup's shuffle no partition holds it."""
    dim = spark.range(50).select(F.col("id").alias("k1"), F.col("id").alias("attribute"))
    joined = lookup_all(stored, [Lookup(dim, "k1")], 0, max_hot=10, min_hot_rows=1)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 20_000 / 8 * 1.8


def test_reports_without_broadcast_are_planned_in_seconds(spark):
    m = Models.from_testdata(spark, SF)
    begin = time.perf_counter()
    fact = marts.fact_trips(m.trip_grain, m.dim_drivers, m.dim_riders, m.dim_cities, broadcast_max_rows=0)
    got = [marts.daily_revenue(fact, m.dim_cities, 0), marts.drivers_leaderboard(fact, m.dim_drivers, m.dim_cities, broadcast_max_rows=0),
           marts.fraud_monitoring(fact, m.dim_cities, m.dim_drivers, m.dim_riders, broadcast_max_rows=0)]
    for df in got:
        _plan(df)
    assert time.perf_counter() - begin < 60
    for df, name in zip(got, ("daily_revenue", "drivers_leaderboard", "fraud_monitoring"), strict=True):
        assert _rows(df) == _rows(m[name])


def test_without_hot_keys_the_fan_out_is_one_join(spark):
    """No second branch of either side; with hot keys their filter reaches the scan."""
    from fareflow.operators.joins import fanout_left_join, hot_keys, lookup_left_join

    path = shared_table_path(spark, "fan-out")
    spark.range(200).select(F.when(F.col("id") < 100, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")).write.parquet(path)
    many, one = spark.read.parquet(path), spark.range(300).select(F.col("id").alias("k"), (-F.col("id")).alias("w"))
    for top, branches in ((1, 1), (2, 2)):
        hot = hot_keys(many, "k", max_keys=top, min_rows=1)
        for joined, base in ((fanout_left_join(one, many, "k", hot), one.join(many, "k", "left")),
                             (lookup_left_join(many, one, "k", hot, keyed=True), many.join(one, "k", "left"))):
            plan = _plan(joined)
            assert plan.count("FileScan parquet") == branches
            pushed = [line.split("PushedFilters: ")[1] for line in plan.splitlines() if "PushedFilters" in line]
            assert top == 1 or any("EqualTo(k,5)" in line and "Not" not in line.split("IsNotNull(k)")[-1] for line in pushed), pushed
            assert _rows(joined) == _rows(base.select(*joined.columns))
