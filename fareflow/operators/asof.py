"""Point-in-time lookup (I3, I4): the version of a key that was valid at a row's time.

A plain join on the key with ``valid_from <= at < valid_to`` as condition compares every row of a key with
each of its versions, and one hot key meets in one task.  Here rows and versions of a key are put in
one sequence by time, and a row takes the last version before it.  The sequence is cut into chunks
of time, so a hot key is spread over its chunks (as in ``sessions.next_event``); what a chunk inherits is the
last version of the key's chunks before, found over one row per key and chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Shares that the rows without a key are dealt into.
_SPREAD = 1 << 16


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, at: str, columns: Sequence[str],
               valid_from: str = "valid_from", valid_to: str = "valid_to", chunk: str = "day") -> DataFrame:
    """``facts`` with ``columns``, ``valid_from`` and ``valid_to`` of the version with
    ``valid_from <= at < valid_to`` (open: null); all null where there is none.

    Versions of a key must not overlap (as those of ``scd2_apply``); of several that start together the
    one with the greatest ``valid_to`` counts (open last), then the greatest columns.  Facts without
    a key or time match nothing; versions without a key or start are left out.  ``chunk`` is a unit
    of ``date_trunc``: the finer, the wider a hot key is spread.
    """
    def chunk_of(time: str) -> Column:
        return F.date_trunc(chunk, F.col(time).cast("timestamp"))

    order = F.struct(F.col(valid_to).isNull(), F.col(valid_to), *[F.col(c) for c in columns])
    # of versions that start together one, before anything is sorted
    known = (versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
             .groupBy(key, valid_from).agg(F.max(order).alias("_v"))
             .select(F.col(key).alias("_key"), F.col(valid_from).cast("timestamp").alias("_time"),
                     F.struct(F.col(valid_from), F.col(f"_v.{valid_to}").alias(valid_to),
                              *[F.col(f"_v.{c}").alias(c) for c in columns]).alias("_version")))
    known = known.withColumn("_chunk", chunk_of("_time")).withColumn("_deal", F.pmod(F.xxhash64("_key"), F.lit(1)))
    no_key = F.col(key).isNull() | F.col(at).isNull()
    deal = F.when(no_key, F.pmod(F.xxhash64(*facts.columns), F.lit(_SPREAD)) + 1).otherwise(F.pmod(F.xxhash64(key), F.lit(1)))
    rows = facts.select(F.when(~no_key, F.col(key)).alias("_key"), F.col(at).cast("timestamp").alias("_time"), F.struct(*facts.columns).alias("_fact"),
                        deal.alias("_deal")).withColumn("_chunk", chunk_of("_time"))
    nothing = F.lit(None)
    sequence = (rows.withColumn("_version", nothing.cast(known.schema["_version"].dataType))
                .unionByName(known.withColumn("_fact", nothing.cast(rows.schema["_fact"].dataType))))
    # at equal times the version comes first: it is valid from its start on
    before = (Window.partitionBy("_key", "_chunk", "_deal").orderBy(F.col("_time").asc_nulls_first(), F.col("_fact").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = sequence.withColumn("_last", F.last("_version", ignorenulls=True).over(before)).where(F.col("_fact").isNotNull())
    # one row per key and chunk: its last version, if any
    chunks = (rows.where(F.col("_key").isNotNull()).select("_key", "_chunk").withColumn("_end", nothing.cast(known.schema["_version"].dataType))
              .distinct().unionByName(known.groupBy("_key", "_chunk").agg(F.max_by("_version", "_time").alias("_end"))))
    chunks = chunks.groupBy("_key", "_chunk").agg(F.max_by("_end", F.col("_end").isNotNull()).alias("_end"))
    earlier = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    inherited = (chunks.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier))
                 .select("_key", "_chunk", F.pmod(F.xxhash64("_key"), F.lit(1)).alias("_deal"), "_before"))
    found = (local.join(inherited, ["_key", "_chunk", "_deal"], "left")
             .withColumn("_found", F.coalesce("_last", "_before")))
    valid = F.col("_found").isNotNull() & (F.col(f"_found.{valid_to}").isNull() | (F.col("_time") < F.col(f"_found.{valid_to}")))
    return found.withColumn("_found", F.when(valid, F.col("_found"))).select(
        "_fact.*", *[F.col(f"_found.{c}").alias(c) for c in [*columns, valid_from, valid_to]])
