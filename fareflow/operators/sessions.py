"""Next-event lookup and open/close session pairing.

``next_event`` is LEAD(ts), LEAD(status) per key in (ts, tiebreak) order,
computed in two levels so that a key holding a large share of all events is
not one window partition:

1. rows are cut into chunks ``(key, date_trunc(chunk, ts))`` and LEAD runs
   inside each chunk (the window shuffles by key *and* chunk);
2. the first event of every chunk is kept (one row per key and chunk) and
   a second LEAD over those heads, per key, gives each chunk its successor
   chunk's first event;
3. the last row of a chunk takes its successor from step 2.

Timestamps order the chunks the same way they order the rows, so the result
equals a single LEAD per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.functions.dates import elapsed


def next_event(events: DataFrame, key: str, ts: str, status: str, tiebreak: str,
               chunk: str = "day") -> DataFrame:
    """``events`` + ``next_ts``, ``next_status`` (NULL for a key's last event)."""
    # a NULL timestamp forms its own, first chunk: a plain number, so that the join below is a plain
    # equality on the columns by which the events are already partitioned
    e = events.withColumn("_chunk", F.coalesce(F.unix_micros(F.date_trunc(chunk, F.col(ts)).cast("timestamp")),
                                               F.lit(-(2**63)).cast("bigint")))
    w = Window.partitionBy(key, "_chunk").orderBy(F.col(ts).asc_nulls_first(), F.col(tiebreak).asc_nulls_first())
    e = (e.withColumn("_pos", F.row_number().over(w))
          .withColumn("_has_next", F.lead(F.lit(True)).over(w))
          .withColumn("next_ts", F.lead(ts).over(w))
          .withColumn("next_status", F.lead(status).over(w)))
    heads = e.filter(F.col("_pos") == 1).select(key, "_chunk", F.col(ts).alias("_head_ts"),
                                                  F.col(status).alias("_head_status"))
    hw = Window.partitionBy(key).orderBy(F.col("_chunk").asc_nulls_first())
    succ = (heads.withColumn("_succ_ts", F.lead("_head_ts").over(hw))
                 .withColumn("_succ_status", F.lead("_head_status").over(hw))
                 .withColumn("_succ_exists", F.lead(F.lit(True)).over(hw))
                 .select(key, "_chunk", "_succ_ts", "_succ_status", "_succ_exists"))
    j = e.join(succ, [key, "_chunk"], "left")
    last = F.col("_has_next").isNull()
    return (j.withColumn("next_ts", F.when(last, F.col("_succ_ts")).otherwise(F.col("next_ts")))
             .withColumn("next_status", F.when(last, F.col("_succ_status")).otherwise(F.col("next_status")))
             .drop("_chunk", "_pos", "_has_next", "_succ_ts", "_succ_status", "_succ_exists"))


def pair_sessions(events: DataFrame, key: str = "driver_id", ts: str = "event_timestamp",
                  status: str = "driver_status", opens: str = "online", closes: str = "offline",
                  tiebreak: str = "event_id", chunk: str = "day") -> DataFrame:
    """Every ``opens`` event with its session end when the next event closes it.

    Output: key, session_start, session_end, session_duration_minutes,
    activity_date (a session crossing midnight belongs to its start date).
    The LEAD runs over all events before keeping the opening ones.
    """
    n = next_event(events.select(key, ts, status, tiebreak), key, ts, status, tiebreak, chunk)
    closed = F.col("next_status") == closes
    return (n.filter(F.col(status) == opens)
             .select(key,
                     F.col(ts).alias("session_start"),
                     F.when(closed, F.col("next_ts")).alias("session_end"),
                     F.when(closed, elapsed("MINUTE", F.col(ts), F.col("next_ts"))).alias("session_duration_minutes"),
                     F.to_date(F.col(ts)).alias("activity_date")))
