"""Sessions by keyed state: the batch pairing, in any arrival order, over restarts, with one driver only."""

import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from fareflow.operators.sessions import pair_sessions
from fareflow.plans import staging
from fareflow.streaming import keyed_sessions
from fareflow.streaming.keyed_sessions import chunk_rows, run_parts
from fareflow.streaming.status_stream import EVENTS_SCHEMA, disordered_parts, hourly_status_stream, staged_status_stream

BASE = dt.datetime(2020, 1, 1)


def events(spark, n, drivers):
    """``n`` events a quarter of an hour apart."""
    pick = random.Random(4)
    rows = [(i, BASE + dt.timedelta(minutes=15 * i), pick.randrange(drivers), pick.choice(["click", "view"]), 0.0, "") for i in range(n)]
    return spark.createDataFrame(rows, EVENTS_SCHEMA)


def batch(spark, feed, watermark):
    raw = feed.select("event_id", F.col("user_id").alias("driver_id"),
                      F.when(F.col("event_type") == "click", "online").otherwise("offline").alias("status"), F.col("ts").alias("event_timestamp"))
    paired = pair_sessions(staging.stg_status_events(raw)).where("session_end IS NOT NULL")
    passed = feed.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=int(watermark.split()[0]))
    rows = [(r.driver_id, r.session_start, r.session_end) for r in paired.collect()]

    def closed(end):  # the hour in which the event's session ends has passed
        return (end + dt.timedelta(hours=1) - dt.timedelta(microseconds=1)).replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1) <= passed

    return sorted(r for r in rows if closed(r[2]))


def rows(table):
    return sorted((r.driver_id, r.session_start, r.session_end) for r in table.collect())


def test_a_restarted_stream_goes_on_from_its_state(spark):
    """Sessions that begin before the restart and end after it are there; nothing is written twice."""
    start, end = BASE + dt.timedelta(hours=5), BASE + dt.timedelta(hours=16)
    long = spark.createDataFrame([(1000, start, 9, "click", 0.0, ""), (1002, end, 9, "view", 0.0, "")], EVENTS_SCHEMA)
    feed = events(spark, 160, 3).unionByName(long)
    watermark, parts = disordered_parts(feed)
    folder = tempfile.mkdtemp(prefix="fareflow-keyed-sessions-")
    first = rows(run_parts(spark, parts[:3], watermark, folder, folder + "/sink"))
    whole = rows(run_parts(spark, parts[3:], watermark, folder, folder + "/sink"))
    want = batch(spark, feed, watermark)
    assert whole == want and len(want) > 8 and set(first) < set(whole)
    assert (9, start, end) in whole and (9, start, end) not in first


def test_one_driver_holds_all_events(spark):
    """Its events are gathered by hour: no group is larger than an hour's events."""
    feed = events(spark, 120, 1)
    staged = feed.select("event_id", F.lit(0).alias("driver_id"), F.when(F.col("event_type") == "click", "online").otherwise("offline").alias("driver_status"),
                         F.col("ts").cast("timestamp").alias("event_timestamp"), F.col("ts").cast("timestamp").alias("closed_at"))
    chunks = chunk_rows(staged)
    assert chunks.count() == 30 and max(len(r.starts) for r in chunks.collect()) <= 2
    watermark, parts = disordered_parts(feed)
    folder = tempfile.mkdtemp(prefix="fareflow-keyed-sessions-")
    assert rows(run_parts(spark, [parts[0].unionByName(parts[1]), *parts[2:]], watermark, folder, folder + "/sink")) == batch(spark, feed, watermark)


def test_the_state_is_found_by_key_and_python_is_called_by_block(spark, monkeypatch):
    """No step scans the state for an event's neighbours, and the drivers of a block share their messages to the state store."""
    reports, finished = [], keyed_sessions.finished

    def kept(query):
        late = finished(query)
        reports.extend(op for p in query.recentProgress for op in p["stateOperators"])
        return late

    monkeypatch.setattr(keyed_sessions, "finished", kept)
    feed = events(spark, 400, 40)
    folder = tempfile.mkdtemp(prefix="fareflow-keyed-sessions-")
    assert rows(run_parts(spark, [feed], "3600 seconds", folder, folder + "/sink")) == batch(spark, feed, "3600 seconds")
    assert not [op for op in reports if "sessionWindow" in op["operatorName"]]
    calls = sum(op["numRowsUpdated"] for op in reports if op["operatorName"].startswith("transformWithState"))
    assert 0 < calls <= 3


def test_hours_give_the_events_of_session_windows(spark):
    """Copies on the hour, exactly an hour apart, a microsecond more, chained over hours and of other drivers."""
    pick = random.Random(11)
    near = [dt.timedelta(microseconds=m) for m in (-1, 0, 0, 1)]
    copies = [(i, BASE + dt.timedelta(minutes=20 * pick.randrange(21)) + pick.choice(near), pick.randrange(3), pick.choice(["click", "view", "error"]), 0.0, "")
              for i in range(400) for _ in range(pick.randrange(1, 7))]
    feed = spark.createDataFrame([*copies, (1, None, 1, "view", 0.0, ""), (None, BASE, 1, "view", 0.0, "")], EVENTS_SCHEMA)
    columns = ["event_id", "driver_id", "driver_status", "event_timestamp"]
    hourly = hourly_status_stream(feed).cache()
    want = sorted(map(tuple, staged_status_stream(feed).select(*columns).collect()))
    assert sorted(map(tuple, hourly.select(*columns).collect())) == want and len(want) > 300
    ends = F.date_trunc("hour", F.expr("event_timestamp + INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND"))
    assert hourly.where(F.date_trunc("hour", "closed_at") != ends).count() == 0
