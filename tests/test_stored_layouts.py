"""Bucketed tables and mergeable distinct counts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fareflow.operators.distinct import distinct_sketches, exact_counts, merged_counts, standard_error
from fareflow.operators.incremental import shared_table_path
from fareflow.plans import intermediate, operator_queries
from fareflow.plans.operator_queries import bucketed_trip_tables
from fareflow.plans.pipeline import Models
from fareflow.sources.sinks import write_bucketed

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    m = Models.from_testdata(spark, SF)
    trips, payments = bucketed_trip_tables(m)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables beyond it
    try:
        joined = trips.join(payments.drop("created_at"), "trip_id", "left")
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" not in _plan(payments.groupBy("trip_id").count())
        # the whole fan-out model: hot trips by broadcast, no row of either table is shuffled by trip
        details = intermediate.int_trip_details(trips, payments, intermediate.trip_hot_keys(payments))
        assert "Exchange hashpartitioning(trip_id" not in _plan(details)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plain = m.stg_trips.join(m.stg_payments.drop("created_at"), "trip_id", "left")
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.select(*joined.columns).collect()))
    assert sorted(map(repr, details.collect())) == sorted(map(repr, m.int_trip_details.collect()))


def test_a_bucket_is_one_sorted_file(spark):
    path = shared_table_path(spark, "one-file")
    name = f"one_file_{path.rsplit('-', 1)[1]}"
    table = write_bucketed(spark.range(1000).withColumn("v", F.col("id") % 7), name, path, "id", 4)
    assert len(table.inputFiles()) == 4
    for file in table.inputFiles():
        ids = [r.id for r in spark.read.parquet(file).collect()]
        assert ids == sorted(ids)
    write_bucketed(spark.range(10).withColumn("v", F.lit(1)), name, path, "id", 4)  # a full rebuild
    assert spark.table(name).count() == 10


def test_daily_sketches_merge_to_any_period(spark):
    """Days of overlapping values: the union's estimate is near the exact count, a sum of days is not."""
    days = spark.range(60_000).select(F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 60).cast("int")).alias("day"),
                                      F.when(F.col("id") % 10 > 0, F.col("id") % 7001).alias("user"))
    sketches = distinct_sketches(days, ["day"], "user")
    assert sketches.count() == 60
    month = F.trunc("day", "month").alias("month")
    got = {r.month: r.estimate for r in merged_counts(sketches.select(month, "rows", "sketch"), ["month"]).collect()}
    want = {r.month: r.exact for r in exact_counts(days.select(month, "user"), ["month"], "user").collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) <= 5 * standard_error() * want[k] for k in want)
    assert sum(r.estimate for r in merged_counts(sketches, ["day"]).collect()) > 3 * sum(want.values())
    assert exact_counts(days.where("user IS NULL"), ["day"], "user").agg(F.sum("exact")).first()[0] == 0


def test_a_micro_batch_opens_the_files_of_its_trips_only(spark):
    from fareflow.streaming.status_stream import own_payments

    m = Models.from_testdata(spark, SF)
    _, payments = bucketed_trip_tables(m, 16)
    trips = m.stg_trips.where("trip_id IN (1, 2, 40)").select("trip_id")
    few = own_payments(payments, trips)
    many = own_payments(payments, trips, most=2)  # beyond the bound: a join, the same rows
    assert "SemiJoin" in many._jdf.queryExecution().optimizedPlan().toString() or "LeftSemi" in many._jdf.queryExecution().optimizedPlan().toString()
    want = sorted(map(repr, m.stg_payments.where("trip_id IN (1, 2, 40)").collect()))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.select(*few.columns).collect())) == want and want
    assert own_payments(payments, trips.limit(0)).count() == 0
    own = {r[0] for r in few.select(F.input_file_name()).distinct().collect()}
    others = [f for f in payments.inputFiles() if f not in own]
    assert len(own) <= 3 and len(others) >= 13
    for file in others:  # broken: they cannot be read any more
        path = file.removeprefix("file://")
        os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
        with open(path, "wb") as f:
            f.write(b"broken")
    assert sorted(map(repr, own_payments(payments, trips).collect())) == want
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        payments.count()


def test_staging_views_read_the_kept_staging(spark):
    """After a full run the staging views read what the run read: nothing is deduplicated a second time."""
    m = Models.from_testdata(spark, SF)
    views = operator_queries.staging_views(m)
    plan = views._jdf.queryExecution().withCachedData().toString()
    assert plan.count("InMemoryRelation") == 2 and "Window" not in plan.split("InMemoryRelation")[0]
    m.free()
