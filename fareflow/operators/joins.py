"""Join operators that stay exact and balanced when one key is hot.

* ``hot_keys``: the keys holding at least ``1 / max_keys`` of all rows.  At
  most ``max_keys`` keys can pass that share test, so the result has a proven
  size bound and may be broadcast.
* ``fanout_left_join``: ``one LEFT JOIN many`` where ``one`` is unique per key
  (J1).
* ``lookup_left_join``: ``facts LEFT JOIN dim`` where ``dim`` is unique per
  key (J5).  Broadcasts the dim when a row count proves it small.
* ``lookup_all``: the same for several dims, one after another (J7-J10).

The first two split hot rows from cold ones: the unique side's rows of the hot keys (at
most ``max_keys``) are broadcast to the hot rows, which are never shuffled; the
rest joins on the plain key, so a partitioning by that key is reused and no key
in it holds more than the share that ``hot_keys`` allows.  The hot keys are
literals of the plan, so their filters reach the scans, and where no key is hot
there is one plain join.  The split reads its input twice, so stacked lookups
would double the plan each time; ``lookup_all`` reads its input once, whatever
the number of lookups.
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_HOT_KEYS = 1000
DEFAULT_MIN_HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, max_keys: int = DEFAULT_MAX_HOT_KEYS,
             min_rows: int = DEFAULT_MIN_HOT_ROWS, count_col: str | None = None) -> DataFrame:
    """Keys with ``count * max_keys >= total`` and ``count >= min_rows``.

    ``df`` is either raw rows (counted here, with map-side partial
    aggregation) or already one row per key with ``count_col``.  The total
    is an uncorrelated scalar subquery, evaluated once by Spark.
    """
    if count_col is None:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        count_col = "_n"
    else:
        counts = df.select(key, F.col(count_col))
    total = counts.agg(F.sum(count_col)).scalar()
    return (counts.filter(F.col(key).isNotNull()
                          & (F.col(count_col) * F.lit(max_keys) >= total)
                          & (F.col(count_col) >= F.lit(min_rows)))
            .select(key))


def _values(hot: DataFrame) -> list:
    """The hot keys as a list: ``hot_keys`` bounds their number."""
    return [r[0] for r in hot.collect()]


def _among(key: str, values: list) -> Column:
    return F.col(key).isin(values)


def _beside(key: str, values: list) -> Column:
    return F.col(key).isNull() | ~F.col(key).isin(values) if values else F.lit(True)


def fanout_left_join(one: DataFrame, many: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``one LEFT JOIN many ON key``; the keys of ``hot`` join by broadcast.

    ``one`` must be unique per key, and every key of ``hot`` must have rows in
    ``many`` (``hot_keys(many, key)``), so the hot rows are an inner join.  The
    keys are literals in the plan: their filter reaches the scans on both
    sides, and without hot keys this is one plain join.
    """
    columns = [*one.columns, *(c for c in many.columns if c != key)]
    values = _values(hot)
    if not values:
        return one.join(many, key, "left").select(*columns)
    cold = one.filter(_beside(key, values)).join(many.filter(_beside(key, values)), key, "left")
    fanned = many.filter(_among(key, values)).join(F.broadcast(one.filter(_among(key, values))), key)
    return cold.select(*columns).unionByName(fanned.select(*columns))


_ROW_COUNTS: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def row_count(df: DataFrame) -> int:
    """``df.count()``, remembered per DataFrame object (a dimension is counted
    once per run however many joins it serves)."""
    if df not in _ROW_COUNTS:
        _ROW_COUNTS[df] = df.count()
    return _ROW_COUNTS[df]


# Bytes per value used to bound a broadcast side (strings: the 32-character
# surrogate keys and short names of the dimensions, plus row overhead).
_WIDTH = {"LongType": 8, "IntegerType": 4, "ShortType": 2, "ByteType": 1, "DoubleType": 8, "FloatType": 4,
          "BooleanType": 1, "DateType": 4, "TimestampType": 8, "TimestampNTZType": 8, "DecimalType": 16,
          "StringType": 48}
ROW_OVERHEAD = 16
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row of ``df`` in a broadcast hash relation."""
    return ROW_OVERHEAD + sum(_WIDTH.get(type(f.dataType).__name__, 64) for f in df.schema.fields)


def _small(dim: DataFrame, size_of: DataFrame | None, max_rows: int, max_bytes: int) -> bool:
    """Whether a row count proves ``dim`` (or the table it is a projection of) small enough to broadcast."""
    if max_rows <= 0:
        return False
    rows = row_count(size_of if size_of is not None else dim)
    return rows <= max_rows and rows * row_width(dim) <= max_bytes


def lookup_left_join(facts: DataFrame, dim: DataFrame, key: str, hot: DataFrame | None = None,
                     broadcast_max_rows: int | None = None, how: str = "left",
                     size_of: DataFrame | None = None,
                     broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, keyed: bool = False) -> DataFrame:
    """``facts JOIN dim ON key`` for a dim unique per key.

    * ``broadcast_max_rows``: count the dim (or ``size_of``, a table the
      dim is a filter/projection of: an upper bound); broadcast it when the
      count is within the bound and count x estimated row width of the
      projected dim is within ``broadcast_max_bytes``.
    * otherwise, with ``hot`` given, the dim rows of the hot keys are broadcast
      to the facts of these keys and the rest joins by a shuffle.  Facts
      without a key match nothing; they go the broadcast way, because a
      shuffle would send them all to one task (``keyed``: there are none).
    * otherwise a plain shuffle join (AQE may split skewed partitions).
    """
    columns = [*facts.columns, *(c for c in dim.columns if c != key)]
    if broadcast_max_rows is not None and _small(dim, size_of, broadcast_max_rows, broadcast_max_bytes):
        return facts.join(F.broadcast(dim), key, how)
    if hot is None:
        return facts.join(dim, key, how)
    values = _values(hot)
    if not values and (keyed or not facts.schema[key].nullable):
        return facts.join(dim, key, how).select(*columns)
    cold = facts.filter(F.col(key).isNotNull() & _beside(key, values)).join(dim.filter(_beside(key, values)), key, how)
    apart = facts.filter(F.col(key).isNull() | _among(key, values)).join(F.broadcast(dim.filter(_among(key, values))), key, how)
    return cold.select(*columns).unionByName(apart.select(*columns))


@dataclass(frozen=True)
class Lookup:
    """A dim to look up by ``key`` (unique in ``dim``, named alike in the facts).

    ``how`` is "left" or "inner"; ``size_of`` a table the dim is a projection of, counted in its place;
    ``hot`` the key's hot values as a bounded table (``hot_keys``), if they are known.
    """

    dim: DataFrame
    key: str
    how: str = "left"
    size_of: DataFrame | None = None
    hot: DataFrame | None = None


def hot_values(df: DataFrame, keys: Sequence[str], max_keys: int = DEFAULT_MAX_HOT_KEYS,
               min_rows: int = DEFAULT_MIN_HOT_ROWS) -> dict[str, list]:
    """The hot values of several key columns, found in one pass over ``df``.

    As in ``hot_keys`` a value is hot with at least 1 / ``max_keys`` of all rows and ``min_rows`` rows, so a
    column has at most ``max_keys`` of them: a bounded list on the driver.  Each row is counted
    under all its keys at once (combined in the map tasks).
    """
    if not keys:
        return {}
    slots = [F.struct(F.lit(i).alias("slot"), *(F.col(k).alias(f"k{j}") if i == j else F.lit(None).cast(df.schema[k].dataType).alias(f"k{j}")
                                                for j, k in enumerate(keys))) for i, _ in enumerate(keys)]
    counts = (df.select(F.explode(F.array(*slots)).alias("of")).groupBy("of").agg(F.count(F.lit(1)).alias("n")))
    rows = counts.select("of.*", "n")
    totals = rows.groupBy("slot").agg(F.sum("n").alias("total"))
    hot = (rows.where(F.col("n") >= min_rows).join(F.broadcast(totals), "slot")
           .where(F.col("n") * F.lit(max_keys) >= F.col("total")).collect())
    out: dict[str, list] = {k: [] for k in keys}
    for r in hot:
        value = r[f"k{r['slot']}"]
        if value is not None:
            out[keys[r["slot"]]].append(value)
    return out


# Shares that the rows of hot keys, and those without a key, are dealt into.
SPREAD = 1 << 16


def _spread_join(facts: DataFrame, lookup: Lookup, hot: list) -> DataFrame:
    """``facts JOIN dim`` by one shuffle of the facts in which no key is hot.

    Rows of a hot key take the dim's row from a broadcast of the hot keys' rows (at most as many as
    there are hot keys); in the shuffle they, and rows without a key, are dealt by a hash of the
    whole row under a key that matches nothing.  All others join on their key.
    """
    key, own = lookup.key, [c for c in lookup.dim.columns if c != lookup.key]
    apart = F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))
    share = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(SPREAD)) + 1
    keyed = facts.withColumn("_dealt", F.struct(F.when(~apart, F.col(key)).alias("k"), F.when(apart, share).otherwise(F.lit(0)).cast("long").alias("s")))
    cold = lookup.dim.where(F.col(key).isNotNull()).select(
        F.struct(F.col(key).alias("k"), F.lit(0).cast("long").alias("s")).alias("_dealt"), F.struct(*own).alias("_cold"))
    joined = keyed.join(cold, "_dealt", "left")
    found = F.col("_cold")
    if hot:
        few = lookup.dim.where(F.col(key).isin(hot)).select(F.col(key).alias("_hot_key"), F.struct(*own).alias("_hot"))
        joined = joined.join(F.broadcast(few), F.col(key) == F.col("_hot_key"), "left")
        found = F.coalesce("_cold", "_hot")
    joined = joined.withColumn("_found", found)
    if lookup.how == "inner":
        joined = joined.where(F.col("_found").isNotNull())
    return joined.select(*facts.columns, *[F.col(f"_found.{c}").alias(c) for c in own])


def lookup_all(facts: DataFrame, lookups: Sequence[Lookup], broadcast_max_rows: int,
               broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, max_hot: int = DEFAULT_MAX_HOT_KEYS,
               min_hot_rows: int = DEFAULT_MIN_HOT_ROWS) -> DataFrame:
    """``facts`` joined to each dim of ``lookups``, which are unique per key.

    Dims that a row count proves small are broadcast first.  For the others the hot values of all
    their keys are taken from one pass over the facts (a bounded list), and each lookup shuffles the
    facts once.  The facts are read once for the hot values and once for the joins, however many
    dims there are; no branch of the input is repeated.
    """
    small = [x for x in lookups if _small(x.dim, x.size_of, broadcast_max_rows, broadcast_max_bytes)]
    large = [x for x in lookups if x not in small]
    unknown = [x.key for x in large if x.hot is None]
    hot = hot_values(facts, unknown, max_hot, min_hot_rows)
    out = facts
    for x in small:
        out = out.join(F.broadcast(x.dim), x.key, x.how)
    for x in large:
        out = _spread_join(out, x, hot[x.key] if x.hot is None else _values(x.hot))
    names = [c for x in lookups for c in x.dim.columns if c != x.key]
    return out.select(*facts.columns, *names)
