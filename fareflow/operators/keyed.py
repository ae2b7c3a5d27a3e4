"""Merge by key with a key index beside the table and versions that decide.

``merge_by_key`` finds the old partition of an updated key by reading the whole table's keys, and takes
every source row.  ``merge_keyed`` keeps a small table of (key, partition, version) beside the
date-partitioned one:

* the old partitions of the source's keys come from the index buckets of these keys; of the table only
  the partitions that gain or lose a row are read and rewritten;
* a source row counts only if its version is not lower than that of the stored row, so an old copy
  that comes late changes nothing, whichever batch brings it;
* a deleted key leaves the table, its version stays in the index, and an older copy does not bring it back.

Before the table is written, the new entries go to a pending folder, which is removed when the index is
written (a first merge's becomes the index).  After a failure in between, the next merge counts the partitions named there as
places of the key as well, so no second row of a key survives; running the failed merge again
completes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.keys import packed, unpacked
from fareflow.operators.dedupe import dedupe_latest
from fareflow.operators.incremental import NEW_GOES, NULL_PARTITION, OLD_GOES, _delete, _in_partitions, replace_rows, table_exists, write_partitioned

KEYS_PER_BUCKET = 4_000_000


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, sorted; none if it is missing."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()) if fs.exists(root) else []


def index_path(spark: SparkSession, target_path: str) -> str | None:
    """The table's key index; its folder name says the number of buckets."""
    root = f"{target_path.rstrip('/')}_keys"
    found = [n for n in folders(spark, root) if n.startswith("buckets-")]
    return f"{root}/{found[-1]}" if found else None


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _place(partition: str) -> Column:
    """A partition value as text; rows without one have a folder of their own."""
    return F.coalesce(F.col(partition).cast("string"), F.lit(NULL_PARTITION))


def _move(spark: SparkSession, path: str, to: str) -> None:
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def _write_index(rows: DataFrame, path: str) -> None:
    """Each task writes its rows to their buckets' folders: versions may be as wide as the rows and are not shuffled for it."""
    rows.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows.write.mode("overwrite").partitionBy("_bucket").parquet(path)


def build_index(spark: SparkSession, target_path: str, table: DataFrame, key: str, partition: str, version_type: str) -> str:
    """The index of a table that has none: one reading of its keys; versions are unknown (any is newer)."""
    rows = table.select(key, _place(partition).alias("_place"), F.lit(None).cast(version_type).alias("_version"))
    buckets = 1 + rows.count() // KEYS_PER_BUCKET
    path = f"{target_path.rstrip('/')}_keys/buckets-{buckets}"
    _write_index(rows.withColumn("_bucket", _bucket(key, buckets)), path)
    return path


def merge_keyed(spark: SparkSession, target_path: str, source: DataFrame, key: str, partition: str,
                cluster: Sequence[str] | None = None, version: Column | None = None, deleted: Column | None = None,
                columns: Sequence[str] | None = None, buckets: int | None = None, unique: bool = False) -> None:
    """Upsert ``source`` into the partitioned table at ``target_path``.

    ``columns`` are stored (default: all of the source).  ``version``: an expression over the source,
    compared with the stored one (nulls lowest; equal versions replace, so a merge may be repeated);
    of several source rows of a key the highest counts, ties by the other columns.  Without it every
    source row counts (unique per key) and the index keeps the version it has.  ``deleted``: whether
    the row removes its key.  Rows without a key are left out.  ``buckets`` of the index are chosen
    from the first merge's size; a table without an index gets one.  ``unique``: no key stands in two source rows.
    """
    cluster = list(cluster or [])
    columns = list(columns or source.columns)
    rows = source.select(*columns, (version if version is not None else F.lit(None).cast("struct<v:int>")).alias("_version"),
                         F.coalesce(deleted if deleted is not None else F.lit(False), F.lit(False)).alias("_deleted"))
    kept = [rows.where(F.col(key).isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        if version is not None and not unique and _repeats(kept[0], key):
            kept.append(dedupe_latest(kept[0], [key], ["_version"]).persist(StorageLevel.MEMORY_AND_DISK))
        _merge(spark, target_path.rstrip("/"), kept[-1], key, partition, cluster, columns, version is not None, buckets)
    finally:
        for df in kept:
            df.unpersist()


def _repeats(rows: DataFrame, key: str) -> bool:
    """Whether a key may stand in several rows.  Hashes of the keys are shuffled in place of whole rows; equal
    hashes of two keys only lead to a dedup that finds nothing."""
    return not rows.groupBy(F.xxhash64(key).alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()


def _merge(spark: SparkSession, target: str, rows: DataFrame, key: str, partition: str, cluster: list[str],
           columns: list[str], versioned: bool, buckets: int | None) -> None:
    schema = rows.select(*columns).schema
    version_type = rows.schema["_version"].dataType.simpleString()
    exists = table_exists(spark, target)
    path = index_path(spark, target)
    if path is None and exists:
        path = build_index(spark, target, spark.read.schema(schema).parquet(target), key, partition, version_type)
    if path is None:
        buckets = buckets or 1 + rows.count() // KEYS_PER_BUCKET
        path = f"{target}_keys/buckets-{buckets}"
    buckets = int(path.rsplit("-", 1)[1])
    entry = f"{key} {rows.schema[key].dataType.simpleString()}, _place string, _version {version_type}"
    stored = table_exists(spark, path)
    if stored and not versioned:  # the index knows versions that this merge does not compare
        version_type = spark.read.parquet(path).schema["_version"].dataType.simpleString()
        entry = f"{key} {rows.schema[key].dataType.simpleString()}, _place string, _version {version_type}"
    left = [f"{target}_pending/{n}" for n in folders(spark, f"{target}_pending")]
    names = [key, "_place", "_version"]
    known = [spark.read.schema(entry).parquet(p).select(*names) for p in left]  # of a merge that did not end
    if stored:
        own = reduce(DataFrame.unionByName, [df.select(key) for df in (rows, *known)])
        touched = [r[0] for r in own.select(_bucket(key, buckets)).distinct().collect()]  # at most one a bucket
        known.append(spark.read.schema(f"{entry}, _bucket int").parquet(path).where(F.col("_bucket").isin(touched)).select(*names))
    hexed = key.endswith("_sk") and rows.schema[key].dataType.simpleString() == "string"

    def narrow(df: DataFrame) -> DataFrame:
        return df.withColumn(key, packed(F.col(key))) if hexed else df

    kept: list[DataFrame] = []
    try:
        own = rows.select(key, F.lit(True).alias("_own"), "_deleted", _place(partition).alias("_to"), *(["_version"] if versioned or not known else []))
        if not known:  # no key is known yet: every row counts, nothing is looked up
            keys, others = own, None
        else:
            seen = narrow(reduce(DataFrame.unionByName, known)).groupBy(key).agg(F.max("_version").alias("_seen"), F.collect_set("_place").alias("_places"))
            # keys alone are looked up, the rows themselves are not shuffled for it; entries of other keys pass through
            found = narrow(own).join(seen, key, "full").persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(found)
            found = found.withColumn(key, unpacked(F.col(key))) if hexed else found
            keys = found.where("_own")
            late, others = None, found.where(F.col("_own").isNull())
            if versioned:
                wins = F.col("_seen").isNull() | F.coalesce(F.col("_version") >= F.col("_seen"), F.lit(False))
                late, keys = keys.where(~wins), keys.where(wins)
                others = others.unionByName(late)
            else:
                keys = keys.withColumn("_version", F.col("_seen"))
            others = others.select(key, F.explode_outer("_places").alias("_place"), F.col("_seen").alias("_version"))
        live = rows.where(~F.col("_deleted"))
        entries = keys.select(key, F.when(~F.col("_deleted"), F.col("_to")).alias("_place"), "_version").withColumn("_bucket", _bucket(key, buckets))
        pending = f"{target}_pending/{uuid.uuid4().hex}"
        entries.write.partitionBy("_bucket").parquet(pending)
        if known:
            def values(places: DataFrame) -> DataFrame:
                return places.withColumn(partition, F.when(F.col("_p") != NULL_PARTITION, F.col("_p")).cast(schema[partition].dataType)).drop("_p")

            new = {r[0] for r in values(keys.where(~F.col("_deleted")).select(F.col("_to").alias("_p")).distinct()).collect()}  # bounded by the calendar
            marks = values(keys.select(key, F.explode("_places").alias("_p"))).withColumn("_mark", F.lit(OLD_GOES))
            old = {r[0] for r in marks.select(partition).distinct().collect()}
            if late is not None:
                marks = marks.unionByName(values(late.where(~F.col("_deleted")).select(key, F.col("_to").alias("_p"))).withColumn("_mark", F.lit(NEW_GOES)))
                live = live.where(_in_partitions(partition, sorted(new, key=str)))  # elsewhere no row comes
            table = spark.read.schema(schema).parquet(target) if exists else spark.createDataFrame([], schema)
            replace_rows(spark, target, table, live.select(*columns), marks, key, partition, cluster, new, old)
        else:
            write_partitioned(live.select(*columns), target, partition, cluster)
        if known:
            _write_index(entries.unionByName(others.withColumn("_bucket", _bucket(key, buckets))), path)
        else:  # the pending entries are the index
            _move(spark, pending, path)
        for p in [*left, pending]:
            _delete(spark, p)
    finally:
        for df in kept:
            df.unpersist()
