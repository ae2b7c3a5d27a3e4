"""Type-2 slowly changing dimension.

History rows carry ``valid_from``, ``valid_to`` (NULL while current) and
``is_current``.  A new snapshot is compared with the current versions by
their tracked columns:

* unchanged key  -> current version kept as is
* changed key    -> current version closed at ``effective_at``; a new current
                    version starts at ``effective_at``
* new key        -> first version starts at ``effective_at``
* key missing from the snapshot -> current version kept, or closed at ``effective_at``
                    with ``close_missing`` (rows deleted at the source); if the key comes
                    again, a new version starts then

Closed versions pass through untouched.  One full outer join on the dimension
key sees one row per key on each side; a changed key gives two rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCD_COLUMNS = ["valid_from", "valid_to", "is_current"]


def _same(tracked: Sequence[str], left: str, right: str):
    cond = None
    for c in tracked:
        e = F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}"))
        cond = e if cond is None else cond & e
    return cond


def scd2_init(snapshot: DataFrame, effective_at: dt.datetime) -> DataFrame:
    """First load: every row is the current version from ``effective_at``."""
    return snapshot.select("*", F.lit(effective_at).cast("timestamp").alias("valid_from"),
                           F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"))


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str],
               effective_at: dt.datetime, close_missing: bool = False) -> DataFrame:
    """The new history after applying ``snapshot`` at ``effective_at``.

    Change detection compares the tracked columns null-safely (exact; no
    hash collisions).  ``close_missing``: the snapshot is complete, so a key
    it does not hold is gone.
    """
    eff = F.lit(effective_at).cast("timestamp")
    if not history.filter(F.col("valid_from") > eff).isEmpty():
        raise ValueError("effective_at lies before a version of the history")
    attrs = list(snapshot.columns)
    closed_before = history.filter(~F.col("is_current"))
    current = history.filter(F.col("is_current"))

    old = current.select(F.col(key).alias("_key"), F.struct(*attrs, "valid_from").alias("_old"))
    new = snapshot.select(F.col(key).alias("_new_key"), F.struct(*attrs).alias("_new"))
    both = old.join(new, F.col("_key") == F.col("_new_key"), "full")
    known, seen = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = known & seen & ~_same(tracked, "_old.", "_new.")

    def row(side: str, start, end, open_):
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in attrs], start.alias("valid_from"),
                        end.cast("timestamp").alias("valid_to"), open_.alias("is_current"))

    never = F.lit(None)
    ended = changed | (known & ~seen) if close_missing else changed
    kept = row("_old", F.col("_old.valid_from"), F.when(ended, eff), ~ended)
    opened = row("_new", eff, never, F.lit(True))
    rows = both.select(F.explode(F.when(changed, F.array(kept, opened)).when(known, F.array(kept))
                                 .otherwise(F.array(opened))).alias("r")).select("r.*")
    cols = attrs + SCD_COLUMNS
    return closed_before.select(*cols).unionByName(rows.select(*cols))


def current_versions(history: DataFrame) -> DataFrame:
    """I4: the versions the fact looks up."""
    return history.filter(F.col("is_current"))
