"""Full runs: materialised pipeline, quarantine, raw reader, multi-batch streams."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from fareflow.operators.quality import quarantine
from fareflow.plans.pipeline import Models, materialize
from fareflow.session import PipelineConfig
from fareflow.sources.raw import RAW_SCHEMAS, read_raw
from fareflow.streaming import status_stream as S

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


def test_materialized_run_equals_lazy_models(spark):
    wh = tempfile.mkdtemp(prefix="fareflow-wh-")
    lazy = Models.from_testdata(spark, SF)
    stored = Models.from_testdata(spark, SF)
    paths = materialize(stored, wh)
    assert os.path.isdir(paths["fact_trips"])
    for name in ["daily_revenue", "payments_reliability", "drivers_leaderboard", "fraud_monitoring"]:
        assert _rows(stored[name]) == _rows(lazy[name]), name
    # a second run finds nothing above the watermark and leaves the fact unchanged
    before = stored.spark.read.parquet(paths["fact_trips"]).count()
    from fareflow.plans.history import load_fact
    assert load_fact(stored, paths["fact_trips"]).count() == 0
    assert stored.spark.read.parquet(paths["fact_trips"]).count() == before


def test_quarantine_splits_bad_casts(spark):
    df = spark.createDataFrame([("1", "2020-01-01"), ("x", "2020-01-02"), ("3", "not a date"), (None, None)],
                               "id string, d string")
    good, bad = quarantine(df, {"id": "bigint", "d": "date"}, "id")
    assert sorted(r["id"] for r in good.collect() if r["id"] is not None) == [1]
    assert good.count() == 2
    assert sorted(r["failed_columns"] for r in bad.collect()) == ["d", "id"]


def test_lenient_staging_matches_strict_on_clean_input(spark):
    strict = Models.from_testdata(spark, SF)
    lenient = Models.from_testdata(spark, SF, PipelineConfig(strict_casts=False))
    assert _rows(strict.stg_payments) == _rows(lenient.stg_payments)


def test_read_raw_with_declared_schema(spark):
    m = Models.from_testdata(spark, SF)
    path = tempfile.mkdtemp(prefix="fareflow-raw-") + "/payments_raw"
    m.raw["payments_raw"].write.parquet(path)
    back = read_raw(spark, "payments_raw", path)
    assert back.schema == RAW_SCHEMAS["payments_raw"]
    assert back.count() == m.raw["payments_raw"].count()


def test_stream_dedup_keeps_the_latest_copy_of_disordered_events(spark):
    m = Models.from_testdata(spark, SF)
    events = spark.read.schema(S.EVENTS_SCHEMA).parquet(f"{SF}/events.parquet")
    folder = tempfile.mkdtemp(prefix="fareflow-events-")
    watermark = S.disordered(events, folder)
    stream = S.read_stream(spark, f"{folder}/part*", "*.parquet", S.EVENTS_SCHEMA, max_files_per_trigger=1)
    got = S.run_to_table(S.staged_status_stream(stream, watermark), "test-dedup")
    end = events.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=int(watermark.split()[0]) + 3600)
    expect = m.stg_status_events.filter(F.col("event_timestamp").cast("timestamp_ntz") <= F.lit(end))
    assert expect.count() > 0
    assert _rows(got.select(*expect.columns)) == _rows(expect)


def test_stream_reports_late_rows(spark):
    folder = tempfile.mkdtemp(prefix="fareflow-late-")
    for i, (event_id, hour) in enumerate([(1, 20), (2, 21), (3, 1)]):   # the third is far beyond the watermark
        spark.createDataFrame([(event_id, dt.datetime(2020, 1, 1, hour), 7, "click", 0.0, "")], S.EVENTS_SCHEMA) \
            .coalesce(1).write.parquet(f"{folder}/part{i}")
    stream = S.staged_status_stream(S.read_stream(spark, f"{folder}/part*", "*.parquet", S.EVENTS_SCHEMA, 1))
    q = (stream.writeStream.format("noop").option("checkpointLocation", folder + "/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert S.late_rows(q) == 1


def test_snapshot_history_versions(spark):
    from fareflow.plans.history import snapshot

    wh = tempfile.mkdtemp(prefix="fareflow-snap-")
    early = Models.from_testdata(spark, SF, PipelineConfig(as_of=dt.date(2001, 7, 1)))
    late = Models.from_testdata(spark, SF)
    p1 = snapshot(early, wh, dt.datetime(2001, 7, 1))
    first = spark.read.parquet(p1["dim_drivers"])
    n_first = first.count()
    assert first.filter("is_current").count() == n_first
    p2 = snapshot(late, wh, dt.datetime(2001, 8, 2))
    hist = spark.read.parquet(p2["dim_drivers"])
    cur = hist.filter("is_current")
    assert cur.count() == cur.select("driver_id").distinct().count() == late.dim_drivers.count()
    closed = hist.filter(~F.col("is_current"))
    assert closed.filter(F.col("valid_to") != F.lit(dt.datetime(2001, 8, 2))).count() == 0
    assert hist.count() == n_first + closed.count()


def test_an_unfinished_history_version_is_ignored(spark):
    from fareflow.plans.history import history_versions, store_history, stored_history

    path = tempfile.mkdtemp(prefix="fareflow-hist-") + "/h"
    for n in (1, 2, 3):
        store_history(spark, spark.range(n), path)
    assert [v.rsplit("/", 1)[1] for v in history_versions(spark, path)] == ["v000002", "v000003"]
    os.remove(f"{path}/v000003/_SUCCESS")   # as after a crash while writing
    assert stored_history(spark, path).count() == 2
    store_history(spark, spark.range(5), path)
    assert stored_history(spark, path).count() == 5


def test_cli_run_on_landing_tables(spark, capsys):
    from fareflow.__main__ import main

    m = Models.from_testdata(spark, SF)
    landing, wh = (tempfile.mkdtemp(prefix=f"fareflow-{k}-") for k in ("landing", "wh"))
    for name, df in m.raw.items():
        df.write.parquet(f"{landing}/{name}")
    assert main(["run", "--landing", landing, "--warehouse", wh]) == 0
    from fareflow.plans.pipeline import read_report
    got = read_report(spark, wh, "daily_revenue")
    assert _rows(got) == _rows(m.daily_revenue.select(*got.columns))
    days = [(-r["revenue_date"].toordinal(), r["city_name"]) for r in got.collect()]
    assert days == sorted(days)
    capsys.readouterr()
    assert main(["report", "--landing", landing, "--warehouse", wh, "--report", "daily_revenue"]) == 0
    assert "revenue_date" in capsys.readouterr().out


def test_cli_test_and_freshness(spark, capsys):
    from fareflow.__main__ import main

    code = main(["freshness", "--sf-dir", SF])
    out = capsys.readouterr().out
    assert "cities_raw" in out and "column missing" in out
    assert code in (0, 1)
    code = main(["test", "--sf-dir", SF])
    out = capsys.readouterr().out
    assert "not_null" in out and code == 1   # the raw test data violates declared rules


def test_fact_without_broadcast_equals_broadcast(spark):
    """The shuffle (hot rows apart) lookup path gives the same fact as the broadcast path."""
    from fareflow.operators.joins import hot_keys
    from fareflow.plans import marts

    m = Models.from_testdata(spark, SF)
    hot_d = hot_keys(m.stg_trips, "driver_id", max_keys=10, min_rows=1)   # driver 0 (30 % of trips) is hot
    assert hot_d.count() >= 1
    shuffled = marts.fact_trips(m.trip_grain, m.dim_drivers, m.dim_riders, m.dim_cities, broadcast_max_rows=0,
                                driver_hot=hot_d, rider_hot=hot_keys(m.stg_trips, "rider_id", 10, 1))
    assert _rows(shuffled) == _rows(m.fact_trips)


def test_tune_for_input_sizes_partitions(spark):
    from fareflow.session import input_bytes, tune_for_input

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = input_bytes(spark, [f"{SF}/lineitem.parquet", f"{SF}/orders.parquet"])
        assert n > 0
        assert tune_for_input(spark, n) == 200                      # small input: the floor
        assert tune_for_input(spark, 100 * 1024 ** 4) == 409600     # 100 TB at 256 MB per partition
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(512 * 1024 * 1024)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
