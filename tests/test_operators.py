"""Operator tests on hand rows: ties, skew paths, distributed rank, merge and SCD2 properties."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.operators.dedupe import dedupe_latest
from fareflow.operators.incremental import merge_by_key, shared_table_path
from fareflow.operators.joins import fanout_left_join, hot_keys, lookup_left_join
from fareflow.operators.quality import check_accepted, check_not_null, check_unique, freshness
from fareflow.operators.ranking import global_rank, rank_within, top_n_per
from fareflow.operators.scd import scd2_apply, scd2_init
from fareflow.operators.sessions import next_event, pair_sessions


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_dedupe_latest_tiebreak_and_idempotent(spark):
    t = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([(1, t, 5, "a"), (1, t, 7, "b"), (1, None, 9, "c"), (2, t, 1, "x"), (None, t, 1, "n")],
                               "k bigint, ts timestamp, seq bigint, v string")
    once = dedupe_latest(df, ["k"], ["ts"], ["seq"])
    assert _rows(once, ["k"]) == [(1, t, 7, "b"), (2, t, 1, "x")]
    twice = dedupe_latest(once, ["k"], ["ts"], ["seq"])
    assert _rows(twice, ["k"]) == _rows(once, ["k"])
    # default tie-break: remaining columns, so arrival order never matters
    shuffled = df.orderBy(F.rand(7))
    assert _rows(dedupe_latest(shuffled, ["k"], ["ts"]), ["k"]) == _rows(dedupe_latest(df, ["k"], ["ts"]), ["k"])


def test_hot_keys_bound(spark):
    df = spark.createDataFrame([(0,)] * 50 + [(i,) for i in range(1, 51)], "k bigint")
    hot = hot_keys(df, "k", max_keys=10, min_rows=1)
    assert [r[0] for r in hot.collect()] == [0]


def test_fanout_left_join_equals_plain(spark):
    one = spark.createDataFrame([(k, f"t{k}") for k in range(6)], "k bigint, a string")
    many = spark.createDataFrame([(0, i) for i in range(40)] + [(1, 100), (1, 101), (3, 300), (9, 900)],
                                 "k bigint, pid bigint")
    hot = hot_keys(many, "k", max_keys=4, min_rows=1)
    assert {r[0] for r in hot.collect()} == {0}
    split = fanout_left_join(one, many, "k", hot)
    plain = one.join(many, "k", "left").select("k", "a", "pid")
    order = ["k", "pid"]
    assert _rows(split, order) == _rows(plain, order)


def test_lookup_left_join_paths_agree(spark):
    facts = spark.createDataFrame([(0, i) for i in range(30)] + [(1, 1), (2, 2), (7, 7)], "k bigint, id bigint")
    dim = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "k bigint, name string")
    hot = hot_keys(facts, "k", max_keys=4, min_rows=1)
    expect = _rows(facts.join(dim, "k", "left").select("k", "id", "name"), ["id", "k"])
    assert _rows(lookup_left_join(facts, dim, "k", hot=hot), ["id", "k"]) == expect
    assert _rows(lookup_left_join(facts, dim, "k", broadcast_max_rows=10), ["id", "k"]) == expect
    inner = lookup_left_join(facts, dim, "k", hot=hot, how="inner")
    assert inner.count() == 32


def test_next_event_two_level_equals_single_lead(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for eid in range(600):
        drv = 0 if eid % 3 else rnd.randint(1, 5)   # driver 0 holds two thirds
        ts = base + dt.timedelta(minutes=rnd.randint(0, 6 * 24 * 60))
        rows.append((eid, drv, rnd.choice(["online", "offline"]), ts))
    rows.append((9999, 0, "online", rows[0][3]))    # tie on timestamp, broken by event id
    df = spark.createDataFrame(rows, "event_id bigint, driver_id bigint, driver_status string, event_timestamp timestamp")
    w = Window.partitionBy("driver_id").orderBy("event_timestamp", "event_id")
    expect = df.select("event_id", F.lead("event_timestamp").over(w).alias("next_ts"),
                       F.lead("driver_status").over(w).alias("next_status"))
    for chunk in ["hour", "day"]:
        got = next_event(df, "driver_id", "event_timestamp", "driver_status", "event_id", chunk) \
            .select("event_id", "next_ts", "next_status")
        assert _rows(got, ["event_id"]) == _rows(expect, ["event_id"])


def test_pair_sessions_uses_all_events(spark):
    t = dt.datetime(2024, 1, 1, 23, 50)
    ev = [(1, 7, "online", t), (2, 7, "offline", t + dt.timedelta(minutes=30)),
          (3, 7, "online", t + dt.timedelta(hours=1)), (4, 7, "online", t + dt.timedelta(hours=2))]
    df = spark.createDataFrame(ev, "event_id bigint, driver_id bigint, driver_status string, event_timestamp timestamp")
    s = _rows(pair_sessions(df), ["session_start"])
    # first session crosses midnight and belongs to its start date; the others stay open
    assert s[0][2:] == (t + dt.timedelta(minutes=30), 30, dt.date(2024, 1, 1))
    assert [r[3] for r in s[1:]] == [None, None]


def test_global_rank_matches_window_rank(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(i, rnd.choice([None, 1.0, 2.0, 3.0, 5.0, 8.0]), i % 4) for i in range(400)],
                               "id bigint, v double, g bigint")
    expect = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    got = global_rank(df, "v", "r", partitions=7)
    assert _rows(got.select("id", "r"), ["id"]) == _rows(expect.select("id", "r"), ["id"])
    top = top_n_per(df, ["g"], ["v"], 3, "gr")
    assert top.filter(F.col("gr") > 3).count() == 0
    assert rank_within(df, ["g"], ["v"], "gr").filter("gr = 1").count() >= 4


def _fact_rows(spark, rows):
    return spark.createDataFrame(rows, "k string, d date, v bigint")


def test_merge_by_key_properties(spark):
    path = shared_table_path(spark, "test-merge")
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    merge_by_key(spark, path, _fact_rows(spark, [("a", d1, 1), ("b", d1, 2), ("c", d2, 3)]), "k", "d")
    upd = _fact_rows(spark, [("a", d1, 10), ("d", d2, 4)])
    merge_by_key(spark, path, upd, "k", "d")
    once = _rows(spark.read.parquet(path).select("k", "d", "v"), ["k"])
    merge_by_key(spark, path, upd, "k", "d")   # merging twice = once
    assert _rows(spark.read.parquet(path).select("k", "d", "v"), ["k"]) == once
    assert once == [("a", d1, 10), ("b", d1, 2), ("c", d2, 3), ("d", d2, 4)]


def test_merge_moved_row_leaves_no_stale_partition(spark):
    path = shared_table_path(spark, "test-move")
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 5)
    merge_by_key(spark, path, _fact_rows(spark, [("a", d1, 1), ("b", d2, 2)]), "k", "d")
    merge_by_key(spark, path, _fact_rows(spark, [("a", d2, 9)]), "k", "d")   # d1 becomes empty
    got = _rows(spark.read.parquet(path).select("k", "d", "v"), ["k"])
    assert got == [("a", d2, 9), ("b", d2, 2)]


def test_scd2_one_current_per_key_no_overlap(spark):
    t0, t1, t2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1), dt.datetime(2020, 3, 1)
    s0 = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, tier string")
    s1 = spark.createDataFrame([(1, "a"), (2, "c"), (3, "x")], "id bigint, tier string")
    s2 = spark.createDataFrame([(1, None), (2, "c")], "id bigint, tier string")
    h = scd2_apply(scd2_apply(scd2_init(s0, t0), s1, "id", ["tier"], t1), s2, "id", ["tier"], t2)
    rows = _rows(h, ["id", "valid_from"])
    assert rows == [
        (1, "a", t0, t2, False), (1, None, t2, None, True),
        (2, "b", t0, t1, False), (2, "c", t1, None, True),
        (3, "x", t1, None, True)]
    assert h.filter("is_current").groupBy("id").count().filter("count > 1").count() == 0


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "online"), (1, " ONLINE"), (None, "offline")], "id bigint, s string")
    nn = {r["column"]: r["violations"] for r in check_not_null(df, "t", ["id", "s"]).collect()}
    assert nn == {"id": 1, "s": 0}
    assert check_unique(df, "t", "id").first()["violations"] == 1
    assert check_accepted(df, "t", "s", ["online", "offline"]).first()["violations"] == 1
    f = freshness(df, "t", "missing_col", 60, 120, dt.datetime(2020, 1, 1)).first()
    assert f["status"] == "column missing"
    ts = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0),)], "c timestamp")
    assert freshness(ts, "t", "c", 60, 120, dt.datetime(2020, 1, 1, 1, 30)).first()["status"] == "warn"
    assert freshness(ts, "t", "c", 60, 120, dt.datetime(2020, 1, 1, 2, 1)).first()["status"] == "error"


def test_new_rows_watermark_options(spark):
    """Default `created_at >` misses updates and ties; updated_at / inclusive pick them up."""
    from fareflow.operators.incremental import new_rows

    t = dt.datetime(2020, 1, 1)
    src = spark.createDataFrame([(1, t, t), (2, t + dt.timedelta(hours=1), t + dt.timedelta(hours=1)),
                                 (3, t, t + dt.timedelta(days=2))],
                                "k bigint, created_at timestamp, updated_at timestamp")
    path = shared_table_path(spark, "test-wm")
    src.filter("k < 3").withColumn("updated_at", F.col("created_at")).write.parquet(path)
    wm_created = t + dt.timedelta(hours=1)
    assert new_rows(src, path, "created_at").count() == 0                      # update of k=3 missed
    assert sorted(r.k for r in new_rows(src, path, "created_at", inclusive=True).collect()) == [2]
    assert sorted(r.k for r in new_rows(src, path, "updated_at").collect()) == [3]
    assert new_rows(src, None).count() == 3                                    # no target: full load
    assert new_rows(src, path, watermark=wm_created).count() == 0


def test_stream_dedup_drops_late_duplicates(spark):
    """A duplicate inside the watermark is dropped; the stream keeps one row per event."""
    import glob as _glob
    import os as _os
    import shutil as _shutil
    import tempfile as _tempfile

    from fareflow.streaming import status_stream as S

    base = dt.datetime(2024, 1, 1, 12)
    rows = [(1, base, 7, "click", 0.0, None), (2, base + dt.timedelta(minutes=5), 7, "view", 0.0, None),
            (1, base + dt.timedelta(minutes=1), 7, "click", 0.0, None),     # duplicate of event 1
            (3, base + dt.timedelta(hours=5), 7, "click", 0.0, None)]       # moves the watermark on
    df = spark.createDataFrame(rows, S.EVENTS_SCHEMA)
    folder = _tempfile.mkdtemp(prefix="fareflow-dup-")
    df.coalesce(1).write.parquet(folder + "/x")
    (src,) = _glob.glob(folder + "/x/*.parquet")
    flat = _tempfile.mkdtemp(prefix="fareflow-dup-flat-")
    _shutil.copy(src, flat + "/events_0.parquet")
    out = S.run_to_table(S.staged_status_stream(S.read_stream(spark, flat, "events_*.parquet", S.EVENTS_SCHEMA)),
                         "test-dup")
    got = sorted((r.event_id, r.driver_status) for r in out.collect())
    assert got == [(1, "online"), (2, "offline")]
    assert _os.path.isdir(flat)
