"""Property tests: the skew-safe operators equal their naive forms on random data
in which one key holds a large share of the rows."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.operators.dedupe import dedupe_latest
from fareflow.operators.joins import fanout_left_join, hot_keys, lookup_left_join
from fareflow.operators.ranking import global_rank, rank_within
from fareflow.operators.sessions import next_event

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 1)


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


events = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2, 3]),          # driver 0 is hot
              st.integers(0, 5 * 24 * 60),                   # minute offset over five days
              st.sampled_from(["online", "offline"])),
    min_size=1, max_size=120)


@SETTINGS
@given(events, st.sampled_from(["hour", "day", "week"]))
def test_next_event_equals_lead(spark, evs, chunk):
    rows = [(i, d, s, BASE + dt.timedelta(minutes=m)) for i, (d, m, s) in enumerate(evs)]
    df = spark.createDataFrame(rows, "event_id bigint, driver_id bigint, driver_status string, event_timestamp timestamp")
    w = Window.partitionBy("driver_id").orderBy("event_timestamp", "event_id")
    expect = df.select("event_id", F.lead("event_timestamp").over(w).alias("next_ts"),
                       F.lead("driver_status").over(w).alias("next_status"))
    got = next_event(df, "driver_id", "event_timestamp", "driver_status", "event_id", chunk)
    assert _rows(got.select("event_id", "next_ts", "next_status"), ["event_id"]) == _rows(expect, ["event_id"])


values = st.lists(st.tuples(st.sampled_from(["a", "a", "a", "b", "c", None]),
                            st.one_of(st.none(), st.integers(0, 6))), min_size=1, max_size=150)


@SETTINGS
@given(values, st.integers(1, 9))
def test_distributed_ranks_equal_window_rank(spark, vals, parts):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(vals)], "id bigint, g string, v bigint")
    overall = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    assert _rows(global_rank(df, "v", "r", parts).select("id", "r"), ["id"]) == _rows(overall.select("id", "r"), ["id"])
    per = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    assert _rows(rank_within(df, ["g"], ["v"], "r", parts).select("id", "r"), ["id"]) == \
        _rows(per.select("id", "r"), ["id"])


pairs = st.lists(st.tuples(st.sampled_from([0, 0, 0, 0, 1, 2, 7]), st.integers(0, 10**6)), min_size=0, max_size=120)


@SETTINGS
@given(pairs)
def test_joins_with_hot_keys_apart_equal_plain_joins(spark, many_rows):
    one = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k bigint, a string")
    many = spark.createDataFrame([(k, i * 1000003 + x) for i, (k, x) in enumerate(many_rows)] or [(99, 1)],
                                 "k bigint, pid bigint")
    hot = hot_keys(many, "k", max_keys=3, min_rows=1)
    got = fanout_left_join(one, many, "k", hot)
    assert _rows(got, ["k", "pid"]) == _rows(one.join(many, "k", "left").select("k", "a", "pid"), ["k", "pid"])
    look = lookup_left_join(many, one, "k", hot=hot)
    assert _rows(look, ["pid"]) == _rows(many.join(one, "k", "left").select("k", "pid", "a"), ["pid"])


dups = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=60)


@SETTINGS
@given(dups)
def test_dedupe_is_idempotent_and_picks_max(spark, rows):
    df = spark.createDataFrame(rows, "k bigint, ts bigint, seq bigint")
    once = dedupe_latest(df, ["k"], ["ts"], ["seq"])
    assert _rows(dedupe_latest(once, ["k"], ["ts"], ["seq"]), ["k"]) == _rows(once, ["k"])
    best = {}
    for k, ts, seq in rows:
        best[k] = max(best.get(k, (ts, seq)), (ts, seq))
    assert _rows(once, ["k"]) == sorted((k, ts, seq) for k, (ts, seq) in best.items())
