"""Plan tests: the physical plans keep the properties the design relies on at scale."""

import pytest

from fareflow.operators.dedupe import dedupe_latest
from fareflow.operators.ranking import global_rank, top_n_per
from fareflow.plans.pipeline import Models
from fareflow.session import PipelineConfig

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lazy(spark):
    # cached plans of other tests would be substituted into these plans
    spark.catalog.clearCache()
    return Models.from_testdata(spark, SF, PipelineConfig(reuse=False))


def test_scan_reads_only_used_columns_with_pushed_filters(lazy):
    p = _plan(lazy.stg_status_events)
    assert "IsNotNull(user_id)" in p and "IsNotNull(event_id)" in p and "PushedFilters" in p
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "events" in line][0]
    assert "value" not in scan.split("ReadSchema")[-1] and "props" not in scan.split("ReadSchema")[-1]


def test_dedup_limits_rows_before_the_shuffle(lazy):
    p = _plan(lazy.stg_payments)
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_trip_grain_join_reuses_the_trip_partitioning(spark, lazy):
    """The dedup of trips and the per-trip payment aggregate are both hash
    partitioned by trip_id: the join between them adds no exchange."""
    spark.catalog.clearCache()
    p = _plan(lazy.trip_grain)
    assert p.count("Exchange hashpartitioning(trip_id") == 2
    assert "SortAggregate" in p and "partial_" in p


def test_reports_broadcast_checked_dimensions_and_aggregate_partially(lazy):
    p = _plan(lazy.daily_revenue)
    assert "BroadcastHashJoin" in p
    assert "partial_sum" in p and "partial_count" in p


def test_global_rank_uses_range_partitioning(spark):
    df = spark.range(1000).selectExpr("id", "id % 17 AS v")
    p = _plan(global_rank(df, "v", "r", partitions=4))
    assert "rangepartitioning" in p
    # the only single-partition window is over the per-range counts
    assert p.count("SinglePartition") <= 2


def test_top_n_is_limited_map_side(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS g", "id % 13 AS v")
    p = _plan(top_n_per(df, ["g"], ["v"], 3, "r"))
    assert "WindowGroupLimit" in p


def test_dedupe_tiebreak_in_sort_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k bigint, ts bigint, seq bigint")
    p = _plan(dedupe_latest(df, ["k"], ["ts"], ["seq"]))
    assert "seq" in p.split("WindowGroupLimit")[1]


def test_report_windows_prune_date_partitions_of_the_stored_fact(spark, lazy):
    """On the stored fact (one folder per trip_date) the trailing-window filter
    of the reports becomes a partition filter: other days are not listed or read."""
    import datetime as dt

    from fareflow.functions.dates import trailing_days
    from fareflow.operators.incremental import shared_table_path, write_partitioned

    path = shared_table_path(spark, "plan-fact")
    write_partitioned(lazy.fact_trips, path, "trip_date", ["city_sk", "driver_sk"])
    stored = spark.read.parquet(path)
    recent = trailing_days(stored, "trip_date", 30, dt.date(2001, 8, 2)).select("trip_id", "gross_revenue")
    p = _plan(recent)
    assert "PartitionFilters: [isnotnull(trip_date" in p and "2001-07-03" in p
    assert "ReadSchema: struct<gross_revenue:decimal(28,9),trip_id:bigint>" in p


def test_incremental_watermark_reaches_the_scan(spark, lazy):
    """In a full run the trip grain is a stored table: the high watermark is read
    first and applied as a literal, which parquet receives as a pushed filter."""
    from fareflow.operators.incremental import new_rows, shared_table_path, write_partitioned
    from fareflow.sources.sinks import write_table

    grain = write_table(lazy.trip_grain, shared_table_path(spark, "plan-grain"))
    target = shared_table_path(spark, "plan-target")
    write_partitioned(lazy.fact_trips.filter("trip_date < DATE '1998-01-01'"), target, "trip_date")
    p = _plan(new_rows(grain, target, "created_at").select("trip_id"))
    assert "PushedFilters: [IsNotNull(created_at), GreaterThan(created_at," in p
