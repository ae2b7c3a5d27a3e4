"""Structured Streaming variants of the status feed and the fact load.

* ``staged_status_stream``: the high-volume status feed as a stream: cast to
  UTC timestamps, watermark, whitelist and drop unknown statuses (I5).  The
  copies of an event_id that lie at most ``within`` apart form a session window;
  the latest of them is kept.  The window closes, and the event is emitted, once
  the watermark passes its end (``within`` after the latest copy).  So events
  leave in event-time order whatever order they came in: an event of a later
  micro-batch is never older than one of an earlier.  Rows that come later than
  that are dropped; ``late_rows`` reports how many.
* ``hourly_status_stream``: the same events for a query whose further steps close by the hour, by plain windows
  instead of session windows.
* ``session_stream``: online -> offline pairing per driver (I6): each
  micro-batch runs the batch pairing over its events and the last event of each
  driver seen before.  LEAD is not supported on streams.
* ``fact_stream`` / ``payment_stream``: new orders and new payments feed the
  trip fact through ``foreachBatch`` and the batch merge-by-key (I7).

The last events of a feed stay open until the watermark passes them, as it
does when later events come.

Every stream runs with ``trigger(availableNow=True)`` in ``run_to_table``:
process what is there, stop, return the sink as a table.  Checkpoints and
sinks live under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.clean import whitelist
from fareflow.operators.incremental import shared_table_path
from fareflow.plans.staging import DRIVER_EVENT_STATUSES
from fareflow.sources.sinks import write_bucketed

log = logging.getLogger(__name__)

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

SESSION_COLUMNS = ["driver_id", "session_start", "session_end", "session_duration_minutes", "activity_date"]


def read_stream(spark: SparkSession, folder: str, file_name: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_name)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def mapped_status_stream(events: DataFrame) -> DataFrame:
    """The test feed mapped onto the status contract."""
    raw = events.select(
        "event_id", F.col("user_id").alias("driver_id"),
        F.when(F.col("event_type") == "click", " ONLINE").when(F.col("event_type") == "view", "offline")
         .otherwise(F.col("event_type")).alias("status"),
        F.col("ts").cast("timestamp").alias("event_timestamp"))
    return raw.filter(F.col("event_id").isNotNull() & F.col("driver_id").isNotNull())


RANK = ("event_timestamp", "driver_id", "status")  # the latest copy; ties as in the batch dedup


def known_events(latest: DataFrame, *more: str) -> DataFrame:
    """Staged events of ``latest`` (a struct of ``RANK`` per event) with a known status."""
    return (latest.select("event_id", F.col("latest.driver_id").alias("driver_id"),
                          whitelist("latest.status", DRIVER_EVENT_STATUSES, default="unknown").alias("driver_status"),
                          F.col("latest.event_timestamp").alias("event_timestamp"), *more)
            .filter(F.col("driver_status") != "unknown"))


def staged_status_stream(events: DataFrame, watermark: str = "1 hour", within: str = "1 hour") -> DataFrame:
    """The test feed mapped onto the status contract, then staged, in event-time order."""
    return known_events(mapped_status_stream(events)
                        .withWatermark("event_timestamp", watermark)
                        .groupBy("event_id", F.session_window("event_timestamp", within))
                        .agg(F.max(F.struct(*RANK)).alias("latest")))


def hourly_status_stream(events: DataFrame, watermark: str = "1 hour", hours: int = 1) -> DataFrame:
    """I5 for stateful steps that work by the hour: the events of ``staged_status_stream`` (``within`` of ``hours``) and
    ``closed_at``, which carries the watermark.

    A session window looks its neighbours up in the state by two scans per event.  Here an event's copies of an hour
    (after its start, up to and with its end) make one group, found by its key: any two of them lie within the hour, and the
    next copy, if it follows within an hour, can only lie in the next hour.  So each copy also goes, as a mark, to its event's
    group of the hour before, and a group that is followed this way is not the session's last and gives nothing.  A group is
    closed an hour after its end, the hour in which the session ends that its latest copy closes."""
    length = hours * 3_600_000_000
    at, hour = F.unix_micros("event_timestamp"), F.expr(f"INTERVAL {hours} HOURS")
    micro = F.expr("INTERVAL 1 MICROSECOND")
    sharp = F.pmod(at, F.lit(length)) == 0  # ends its hour: a microsecond less is in it
    own = F.when(sharp, F.col("event_timestamp") - micro).otherwise(F.col("event_timestamp"))
    # times lie an hour ahead, as groups close an hour late, and so does the watermark: the same watermark in the end.
    # The third is for the watermark alone, whose milliseconds the microsecond less would change
    uses = F.array_compact(F.array(F.struct(F.lit("own").alias("use"), (own + hour).alias("hour_after")),
                                   F.struct(F.lit("mark").alias("use"), own.alias("hour_after")),
                                   F.when(sharp, F.struct(F.lit("clock").alias("use"), (F.col("event_timestamp") + hour).alias("hour_after")))))
    groups = (mapped_status_stream(events).where(at.isNotNull())
              .select("*", F.inline(uses))
              .withWatermark("hour_after", f"{watermark} {hours} hours")
              .groupBy("event_id", F.window("hour_after", f"{hours} hours"))
              .agg(F.max(F.when(F.col("use") == "own", F.struct(*RANK))).alias("latest"),
                   F.min(F.when(F.col("use") == "mark", at)).alias("next_at"))
              .select("event_id", "latest", "next_at", F.window_time("window").alias("closed_at")))
    followed = F.coalesce(F.col("next_at") - F.unix_micros("latest.event_timestamp") <= length, F.lit(False))
    return known_events(groups.where(F.col("latest").isNotNull() & ~followed), "closed_at")


def run_to_table(stream: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Run ``stream`` to completion (availableNow) into a table; return the table."""
    spark = stream.sparkSession
    path = shared_table_path(spark, f"{name}-sink")
    q = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", path + "-checkpoint")
         .trigger(availableNow=True).start(path))
    if late := finished(q):
        log.warning("%s: %d rows came after the watermark and were dropped", name, late)
    return spark.read.schema(stream.schema).parquet(path)


def late_rows(progress) -> int:
    """Rows that a stream's stateful operators dropped as later than the watermark, over progress reports
    or over a query's recent ones."""
    reports = getattr(progress, "recentProgress", progress)
    return sum(op["numRowsDroppedByWatermark"] for p in reports for op in p["stateOperators"])


def finished(query, seconds: float = 2) -> int:
    """Wait for the query's end; the rows it dropped as late.  A query keeps its last 100 reports only, so
    they are gathered while it runs."""
    reports: dict[int, dict] = {}
    done = False
    while not done:
        done = query.awaitTermination(seconds)
        for p in query.recentProgress:
            reports[p["batchId"]] = p
    return late_rows(reports.values())


def trip_version(trips_raw: DataFrame) -> Column:
    """A raw trip's place in the order of staging's dedup (W1): the latest ``updated_at``, ties by the other columns."""
    return F.struct("updated_at", *[c for c in trips_raw.columns if c not in ("trip_id", "updated_at")])


# Trips of a micro-batch up to which their ids are brought to the payments' scan.
MOST_IDS = 10_000


def own_payments(payments: DataFrame, trips: DataFrame, most: int = MOST_IDS) -> DataFrame:
    """The payments of ``trips``.

    Few trips (at most ``most``, a bounded list) become a filter on the scan: of a payment table in buckets
    of ``trip_id`` (``write_bucketed``) only the files of their buckets are opened.  More trips are
    a semi-join, which shuffles neither side of tables in such buckets."""
    ids = [r[0] for r in trips.select("trip_id").distinct().limit(most + 1).collect()]
    if len(ids) <= most:
        return payments.where(F.col("trip_id").isin(ids))
    return payments.join(trips.select("trip_id"), "trip_id", "left_semi")


def _refresh(models, trips: DataFrame, ids: DataFrame, payments: DataFrame, target_path: str, gone: DataFrame | None = None) -> None:
    """Build the fact rows of ``trips`` (staged) from their own payments and merge them by key; ``ids`` has all of
    their ``trip_id``s, and may have others.

    With ``gone`` the trips carry their ``_version``: a row counts only if no later copy of its
    trip has been merged before, and a trip of ``gone`` (``trip_id``, ``_version``), whose latest copy staging or the fact leaves
    out (no rider, no known status), goes from the fact, as in a batch run over all copies.
    """
    from fareflow.functions.keys import surrogate_key
    from fareflow.operators.keyed import merge_keyed
    from fareflow.plans import marts
    from fareflow.plans.history import FACT_CLUSTER, FACT_KEY, FACT_PARTITION, build_fact

    carried = ["_version"] if gone is not None else []
    own = own_payments(payments, ids)  # before any aggregation
    fact = build_fact(models, marts.trip_grain(trips, own, *carried), *carried)
    columns, version, deleted, rows = [c for c in fact.columns if c not in carried], None, None, fact
    if gone is not None:
        missing = gone.select(surrogate_key("trip_id").alias(FACT_KEY), "_version", F.lit(True).alias("_gone"))
        rows = fact.withColumn("_gone", F.lit(False)).unionByName(missing, allowMissingColumns=True)
        version, deleted = F.col("_version"), F.col("_gone")
    merge_keyed(trips.sparkSession, target_path, rows, FACT_KEY, FACT_PARTITION, FACT_CLUSTER, version, deleted, columns, unique=True)


def _run_batches(stream: DataFrame, on_batch, checkpoint: str) -> None:
    """Run ``on_batch`` on each micro-batch, computed once for all that it does."""
    def kept(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            on_batch(batch, epoch_id)
        finally:
            batch.unpersist()

    stream.writeStream.foreachBatch(kept).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def fact_stream(spark: SparkSession, orders: DataFrame, models, target_path: str) -> None:
    """Each micro-batch of new orders -> trips -> fact rows -> merge by key.

    Of the payments known so far only those of the batch's trips are summarised;
    payments that come later reach the fact by ``payment_stream``.  A trip may come again in any
    order: its latest copy (W1) decides, whichever micro-batch brings it.
    """
    from fareflow.plans import marts, staging
    from fareflow.sources.adapter import bind_adapter, test_tables

    sf_dir = models.extra_sources["sf_dir"]

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # a micro-batch lives in the stream's own session: the static tables
        # it is bound with in SQL are opened in that session too
        s = batch.sparkSession
        trips_raw = bind_adapter(s, "trips_raw", {**test_tables(s, sf_dir), "orders": batch})
        # the dedup's row is the trip and its version; a trip that goes is told by the filters that leave it out
        latest = staging.cleaned_trips(staging.latest_trips(trips_raw), trip_version(trips_raw).alias("_version"))
        stays = F.coalesce(staging.staged_trip() & marts.fact_status(), F.lit(False))
        _refresh(models, latest.where(stays), trips_raw.select("trip_id"), models.stg_payments, target_path,
                 latest.where(~stays).select("trip_id", "_version"))

    _run_batches(orders, on_batch, target_path + "-checkpoint")


def payment_stream(payment_trips: DataFrame, models, payments: DataFrame, target_path: str) -> None:
    """I7 for late payments: each micro-batch of ``payment_trips`` (column ``trip_id``) names trips
    whose payments changed; their fact rows are built anew from ``payments``, the staged payments
    including the new ones, and merged by key.  A payment whose trip is not there yet waits for
    the trip's own micro-batch."""
    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        touched = batch.select("trip_id").distinct()
        _refresh(models, models.stg_trips.join(touched, "trip_id", "left_semi"), touched, payments, target_path)

    _run_batches(payment_trips, on_batch, target_path + "-payments-checkpoint")


# ---- registered queries ---------------------------------------------------------

def stream_dedup(m) -> DataFrame:
    folder = m.extra_sources["sf_dir"]
    events = read_stream(m.spark, folder, "events.parquet", EVENTS_SCHEMA)
    return run_to_table(staged_status_stream(events), "status-events")


def stream_merge(m) -> DataFrame:
    folder = m.extra_sources["sf_dir"]
    schema = m.spark.read.parquet(f"{folder}/orders.parquet").schema
    orders = read_stream(m.spark, folder, "orders.parquet", schema)
    target = shared_table_path(m.spark, "fact-stream")
    fact_stream(m.spark, orders, m, target)
    return m.spark.read.parquet(target).select(*m.fact_trips.columns)


def stream_late_payments(m) -> DataFrame:
    """The fact first loaded with every other payment, then caught up by the payment stream; the payments
    are stored in buckets of their trips."""
    folder = m.extra_sources["sf_dir"]
    target, path = shared_table_path(m.spark, "fact-late-payments"), shared_table_path(m.spark, "payments-by-trip")
    payments = write_bucketed(m.stg_payments, f"payments_by_trip_{path.rsplit('-', 1)[1]}", path, "trip_id", 8)
    _refresh(m, m.stg_trips, m.stg_trips, payments.filter("payment_id % 20 = 0"), target)
    schema = m.spark.read.parquet(f"{folder}/lineitem.parquet").schema
    lines = read_stream(m.spark, folder, "lineitem.parquet", schema)
    payment_stream(lines.select(F.col("l_orderkey").alias("trip_id")), m, payments, target)
    return m.spark.read.parquet(target).select(*m.fact_trips.columns)


def shuffled_copies(orders: DataFrame) -> list[DataFrame]:
    """``orders`` in three parts with copies of some in each, so that old copies come after and before the
    latest.  A stale copy is three days older, with another price and status; every 89th order gets a
    newer copy without a customer, which staging rejects."""
    key = F.col("o_orderkey")
    stale = (orders.withColumn("o_orderdate", F.expr("o_orderdate - INTERVAL 3 DAYS")).withColumn("o_totalprice", F.col("o_totalprice") * 2)
             .withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "F", "O").otherwise("F")))
    gone = (orders.where(key % 89 == 0).withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 10 DAYS"))
            .withColumn("o_custkey", F.lit(None).cast("bigint")))
    even = key % 2 == 0
    return [orders.where(even).unionByName(stale.where(~even & (key % 7 == 0))).unionByName(gone.where(~even)),
            orders.where(~even).unionByName(stale.where(even & (key % 6 == 0))),
            stale.where(key % 5 == 0).unionByName(gone.where(even))]


def stream_stale_trips(m) -> DataFrame:
    """I7 with W1: orders that come again, old copies last or first, a folder of files per micro-batch."""
    orders = m.spark.read.parquet(f"{m.extra_sources['sf_dir']}/orders.parquet")
    folder, target = shared_table_path(m.spark, "orders-shuffled"), shared_table_path(m.spark, "fact-stale-trips")
    for number, part in enumerate(shuffled_copies(orders)):
        part.write.parquet(f"{folder}/part{number}")
        # the same checkpoint each time: a run takes the new folder
        fact_stream(m.spark, read_stream(m.spark, f"{folder}/part*", "*.parquet", orders.schema), m, target)
    return m.spark.read.parquet(target).select(*m.fact_trips.columns)


def session_stream(staged: DataFrame, sink_path: str, chunk: str = "day") -> DataFrame:
    """Closed online -> offline sessions per driver, across micro-batches.

    ``staged`` gives events in event-time order across micro-batches.  A
    micro-batch's events are stored; with the state (the last event of every
    driver seen so far, one row per driver) they go through ``next_event``, the
    chunked two-level LEAD, so a hot driver is spread over its chunks like in
    batch.  Closed sessions are written to ``sink_path/epoch=<id>``, events and
    new state beside it.  A replayed epoch reads the state of the epoch before
    it and overwrites its own output, so the result is the same after a failure;
    older events and states are removed.
    """
    from fareflow.operators.dedupe import dedupe_latest
    from fareflow.operators.incremental import _delete, table_exists
    from fareflow.operators.sessions import next_event

    cols = ["driver_id", "event_id", "driver_status", "event_timestamp"]

    def stored(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        s = batch.sparkSession
        events = stored(batch.select(*cols), f"{sink_path}-events/epoch={epoch_id}")
        state = f"{sink_path}-state/epoch={epoch_id - 1}"
        if table_exists(s, state):
            events = events.unionByName(s.read.schema(events.schema).parquet(state))
        nxt = next_event(events, "driver_id", "event_timestamp", "driver_status", "event_id", chunk)
        closed = (nxt.filter((F.col("driver_status") == "online") & (F.col("next_status") == "offline"))
                  .select("driver_id", F.col("event_timestamp").alias("session_start"),
                          F.col("next_ts").alias("session_end"),
                          F.timestamp_diff("MINUTE", F.col("event_timestamp"), F.col("next_ts"))
                          .alias("session_duration_minutes"),
                          F.to_date("event_timestamp").alias("activity_date")))
        stored(closed, f"{sink_path}/epoch={epoch_id}")
        stored(dedupe_latest(events, ["driver_id"], ["event_timestamp", "event_id"], []).select(*cols),
               f"{sink_path}-state/epoch={epoch_id}")
        for kind in ("events", "state"):
            _delete(s, f"{sink_path}-{kind}/epoch={epoch_id - 2}")

    q = (staged.writeStream.foreachBatch(on_batch).option("checkpointLocation", sink_path + "-checkpoint")
         .trigger(availableNow=True).start())
    if late := finished(q):
        log.warning("%s: %d rows came after the watermark and were dropped", sink_path, late)
    return staged.sparkSession.read.parquet(sink_path).select(*SESSION_COLUMNS)


def stream_sessions(m) -> DataFrame:
    """I6 over the events as they stand."""
    events = read_stream(m.spark, m.extra_sources["sf_dir"], "events.parquet", EVENTS_SCHEMA)
    return session_stream(staged_status_stream(events), shared_table_path(m.spark, "sessions"))


def disordered_parts(events: DataFrame) -> tuple[str, list[DataFrame]]:
    """``events`` in six parts, far out of order and with stale copies, and the watermark that covers the disorder.

    The odd events of each quarter of the time span come one part later than the even ones; every
    fifth event also has a copy, ten minutes older and of another type, two parts later.
    """
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    span = int((last - first).total_seconds()) + 1
    quarter = F.least(F.lit(3), F.floor(4 * F.timestamp_diff("SECOND", F.lit(first), F.col("ts")) / span))
    tagged = events.withColumn("_part", (quarter + F.col("event_id") % 2).cast("int"))
    stale = (events.filter("event_id % 5 = 0").withColumn("_part", (quarter + 2).cast("int"))
             .withColumn("ts", F.expr("ts - INTERVAL 10 MINUTES"))
             .withColumn("event_type", F.when(F.col("event_type") == "click", "view").otherwise("click")))
    both = tagged.unionByName(stale)
    return f"{span // 2 + 3600} seconds", [both.filter(F.col("_part") == i).drop("_part") for i in range(6)]


def disordered(events: DataFrame, folder: str) -> str:
    """Write the parts of ``disordered_parts`` as folders of files under ``folder``, oldest first; returns the watermark."""
    watermark, parts = disordered_parts(events)
    for i, part in enumerate(parts):  # written in turn: the file source reads the oldest first
        part.write.parquet(f"{folder}/part{i}")
    return watermark


def stream_sessions_distributed(m) -> DataFrame:
    """I6 over ``disordered_parts``, a folder of files per micro-batch: the sessions of the batch pairing."""
    events = m.spark.read.schema(EVENTS_SCHEMA).parquet(f"{m.extra_sources['sf_dir']}/events.parquet")
    folder, sink = shared_table_path(m.spark, "events-disordered"), shared_table_path(m.spark, "sessions-disordered")
    watermark, parts = disordered_parts(events)
    for i, part in enumerate(parts):
        part.write.parquet(f"{folder}/part{i}")
        # the same checkpoint each time: a run takes the new folder
        stream = read_stream(m.spark, f"{folder}/part*", "*.parquet", EVENTS_SCHEMA)
        sessions = session_stream(staged_status_stream(stream, watermark), sink, "hour")
    return sessions
