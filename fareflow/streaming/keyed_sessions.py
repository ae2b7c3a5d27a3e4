"""Sessions of the status feed with keyed state (I6): no table of last events is rewritten per micro-batch.

Three stateful steps in one query, each closed by the watermark:

1. ``hourly_status_stream``: one row per event, once no later copy can come;
2. the events of a driver and chunk of time are gathered until the watermark has passed the chunk, then
   sorted and paired inside it: a busy driver's state is that of its open chunks, spread over tasks;
3. one small row per driver and chunk meets the driver's last event before it, if that opens a session, which
   links the session across chunks.  The state store holds these of ``BLOCK`` neighbouring driver ids as one value,
   as each call of Python costs several messages to the store.  Only blocks of the micro-batch are read or written.

The first two are native aggregates; the third is the only step of the library's streams that runs
Python in a task, on one row per driver and chunk.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fareflow.operators.incremental import shared_table_path
from fareflow.operators.keyed import folders
from fareflow.streaming.status_stream import (EVENTS_SCHEMA, SESSION_COLUMNS, disordered_parts, finished, hourly_status_stream,
                                              read_stream)

log = logging.getLogger(__name__)

STATE_STORE = {
    # the only store with typed state; kept in the checkpoint of the query
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # the number of its rows is only a metric, for which each write would look its key up
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

# Driver ids to a block: as many last events are one value in the state store, read and written together.
BLOCK = 16


def chunk_rows(staged: DataFrame, chunk: str = "1 hour") -> DataFrame:
    """One row per driver and closed chunk: its first and last event and the sessions inside, as microseconds.

    ``staged`` has ``closed_at``, the event-time column of the stream.  Events are ordered by time, then id, as in the batch."""
    event = F.struct(F.unix_micros("event_timestamp").alias("at"), "event_id", "driver_status")
    chunks = (staged.groupBy("driver_id", F.window("closed_at", chunk)).agg(F.array_sort(F.collect_list(event)).alias("events")))
    size = F.size("events")
    pairs = F.arrays_zip(F.slice("events", 1, F.greatest(size - 1, F.lit(0))).alias("a"), F.slice("events", 2, F.greatest(size - 1, F.lit(0))).alias("b"))
    sessions = F.filter(pairs, lambda p: (p["a"]["driver_status"] == "online") & (p["b"]["driver_status"] == "offline"))
    first, last = F.col("events")[0], F.element_at("events", -1)
    return chunks.select(
        "driver_id", F.unix_micros("window.start").alias("chunk"), first["at"].alias("first_at"), first["driver_status"].alias("first_status"),
        last["at"].alias("last_at"), last["driver_status"].alias("last_status"),
        F.transform(sessions, lambda p: p["a"]["at"]).alias("starts"), F.transform(sessions, lambda p: p["b"]["at"]).alias("ends"))


def packed(chunks: DataFrame) -> DataFrame:
    """``chunk_rows`` as ``block`` and one array of numbers: Python reads a row cell by cell, at a cost for each.

    Driver, first event's time, whether it closes, last event's time, whether it opens, starts and ends in turn."""
    inner = F.flatten(F.transform(F.arrays_zip("starts", "ends"), lambda s: F.array(s["starts"], s["ends"])))
    closes, opens = F.col("first_status") == "offline", F.col("last_status") == "online"
    head = F.array("driver_id", "first_at", closes.cast("long"), "last_at", opens.cast("long"))
    return chunks.select(F.expr(f"driver_id div {BLOCK}").alias("block"), F.concat(head, inner).alias("row"))


class LinkChunks(StatefulProcessor):
    """Sessions of a block's drivers in and across their chunks; the state is the drivers whose last event opens one, and its time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "drivers array<long>, ats array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        open_at = dict(zip(*(self.open.get() or ([], [])), strict=True))
        # chunks of a driver come in order from one micro-batch to the next; those of one are few: sort them
        for driver, first_at, closes, last_at, opens, *inner in sorted(row["row"] for row in rows):
            start = open_at.pop(driver, None)
            if start is not None and closes:
                yield Row(driver_id=driver, start_us=start, end_us=first_at)
            for start, end in zip(inner[::2], inner[1::2], strict=True):
                yield Row(driver_id=driver, start_us=start, end_us=end)
            if opens:
                open_at[driver] = last_at
        self.open.update((list(open_at), list(open_at.values())))

    def close(self) -> None:
        pass


def keyed_session_stream(staged: DataFrame, sink_path: str, chunk: str = "1 hour") -> DataFrame:
    """Closed online -> offline sessions, appended to ``sink_path``; runs what is there, stops, returns the table.

    The checkpoint beside the sink holds the state: a later call goes on from it, and a micro-batch that
    failed is run again on the state before it.
    """
    spark = staged.sparkSession
    linked = (packed(chunk_rows(staged, chunk)).groupBy("block")
              .transformWithState(LinkChunks(), "driver_id long, start_us long, end_us long", "append", "none"))
    start, end = F.timestamp_micros("start_us"), F.timestamp_micros("end_us")
    out = linked.select("driver_id", start.alias("session_start"), end.alias("session_end"),
                        F.timestamp_diff("MINUTE", start, end).alias("session_duration_minutes"), F.to_date(start).alias("activity_date"))
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        query = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", sink_path + "-checkpoint")
                 .trigger(availableNow=True).start(sink_path))
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    if late := finished(query):
        log.warning("%s: %d rows or their marks came after the watermark and were dropped", sink_path, late)
    return spark.read.schema(out.schema).parquet(sink_path).select(*SESSION_COLUMNS)


def run_parts(spark: SparkSession, parts: list[DataFrame], watermark: str, folder: str, sink: str) -> DataFrame:
    """Write each part as a folder of files and run the stream on it, with one checkpoint."""
    for part in parts:
        number = len(folders(spark, folder))
        part.write.parquet(f"{folder}/part{number}")
        stream = read_stream(spark, f"{folder}/part*", "*.parquet", EVENTS_SCHEMA)
        sessions = keyed_session_stream(hourly_status_stream(stream, watermark), sink)
    return sessions


def stream_sessions_keyed(m) -> DataFrame:
    """I6 with keyed state over ``disordered_parts``: the sessions of the batch pairing."""
    events = m.spark.read.schema(EVENTS_SCHEMA).parquet(f"{m.extra_sources['sf_dir']}/events.parquet")
    watermark, parts = disordered_parts(events)
    return run_parts(m.spark, parts, watermark, shared_table_path(m.spark, "events-keyed"), shared_table_path(m.spark, "sessions-keyed"))
