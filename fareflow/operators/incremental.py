"""Incremental load and merge-by-key into a date-partitioned parquet table.

``new_rows``   rows of ``source`` above the target's high-watermark; an empty
               or missing target means a full load.  The watermark is read
               with one aggregate and applied as a literal, so it reaches the
               parquet scan as a pushed filter.
``merge_by_key`` upsert ``source`` into ``target_path`` by ``key``: only the
               partitions that receive a row, or lose one (a key that moved
               to another date), are rewritten, with dynamic partition
               overwrite.  A partition left with no row is removed
               explicitly, so a moved key never survives in its old date.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.keys import packed, unpacked
from fareflow.session import ensure_checkpoint_dir


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def shared_table_path(spark: SparkSession, name: str) -> str:
    """A fresh table location under the cluster's shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables/{name}-{uuid.uuid4().hex[:12]}"


def high_watermark(spark: SparkSession, target_path: str, col: str):
    """max(col) of the target, or None when the target is missing or empty."""
    if not table_exists(spark, target_path):
        return None
    return spark.read.parquet(target_path).agg(F.max(col)).first()[0]


def new_rows(source: DataFrame, target_path: str | None, watermark_col: str = "created_at",
             inclusive: bool = False, watermark=None) -> DataFrame:
    """The delta of ``source`` for the next run.

    Default rule: ``watermark_col > max(target.watermark_col)``.  Use
    ``watermark_col='updated_at'`` to pick up later changes to old rows and
    ``inclusive=True`` to re-read rows tied at the maximum (the merge by key
    makes re-reads harmless).
    """
    if watermark is None and target_path is not None:
        watermark = high_watermark(source.sparkSession, target_path, watermark_col)
    if watermark is None:
        return source
    c = F.col(watermark_col)
    return source.filter(c >= F.lit(watermark) if inclusive else c > F.lit(watermark))


def write_partitioned(df: DataFrame, path: str, partition: str, cluster: list[str] | None = None,
                      mode: str = "overwrite") -> None:
    """One directory per ``partition`` value, files sorted by ``cluster``.

    Rows are range-partitioned on (partition, *cluster): a day with many
    rows spans several write tasks (several files in its directory) instead
    of one task per day, and every file covers a narrow, sorted
    (city_sk, driver_sk) range, so parquet min/max statistics skip row groups.  Surrogate keys are
    shuffled as bytes.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = [partition] + list(cluster or [])
    sk = [f.name for f in df.schema.fields if f.name.endswith("_sk") and isinstance(f.dataType, T.StringType)]
    rows = df.select(*[packed(F.col(c)).alias(c) if c in sk else F.col(c) for c in df.columns])
    rows = rows.repartitionByRange(n, *[unpacked(F.col(c)) if c in sk else F.col(c) for c in keys])
    out = rows.select(*[unpacked(F.col(c)).alias(c) if c in sk else F.col(c) for c in df.columns]).sortWithinPartitions(*keys)
    out.write.mode(mode).partitionBy(partition).parquet(path)


# Hive-style folder of the rows whose partition value is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _in_partitions(column: str, values: list):
    """Whether the partition value is one of ``values``; None stands for NULL, which ``isin`` never matches."""
    among = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
    return among | F.col(column).isNull() if None in values else among


def merge_by_key(spark: SparkSession, target_path: str, source: DataFrame, key: str, partition: str,
                 cluster: list[str] | None = None, partition_immutable: bool = False) -> None:
    """Upsert ``source`` (unique per ``key``) into the partitioned table.

    Finding the old partition of an updated key reads the (key, partition)
    columns of the whole target.  ``partition_immutable=True`` states that a
    key never changes partition (e.g. the date of a trip's request), so only
    the source's own partitions are read and rewritten.

    Rows without a partition value are a partition of their own: a key may
    move into or out of it like any other.
    """
    if not table_exists(spark, target_path):
        write_partitioned(source, target_path, partition, cluster)
        return
    # the source is read three times below (its partitions, the key lookup, the write):
    # computed once and kept (recomputed from lineage if an executor is lost)
    source = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _merge_into(spark, target_path, source, key, partition, cluster, partition_immutable)
    finally:
        source.unpersist()


def _merge_into(spark: SparkSession, target_path: str, source: DataFrame, key: str, partition: str,
                cluster: list[str] | None, partition_immutable: bool) -> None:
    target = spark.read.parquet(target_path)
    # partitions that gain a row (the source's) ...
    new_parts = {r["_p"] for r in source.select(F.col(partition).alias("_p")).distinct().collect()}
    # ... and partitions holding an old version of a source key (a moved key)
    old_parts: set = set()
    marks = source.select(key, partition)
    if not partition_immutable:
        marks = target.join(source.select(F.col(key).alias("_k")), target[key] == F.col("_k")).select(target[key], target[partition])
        marks = marks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not partition_immutable:
            old_parts = {r["_p"] for r in marks.select(F.col(partition).alias("_p")).distinct().collect()}
        replace_rows(spark, target_path, target, source, marks.withColumn("_mark", F.lit(OLD_GOES)), key, partition, cluster, new_parts, old_parts)
    finally:
        marks.unpersist()


# What a mark says of the rows of its key in its partition.
OLD_GOES, NEW_GOES = 1, 2
# Rows of a partition that one task writes; of a larger table its share of the tasks.
ROWS_PER_SHARE = 1_000_000


def replace_rows(spark: SparkSession, target_path: str, target: DataFrame, source: DataFrame, marks: DataFrame, key: str, partition: str,
                 cluster: list[str] | None, new_parts: set, old_parts: set) -> None:
    """Rewrite the partitions ``new_parts`` (which gain rows) and ``old_parts`` (which hold rows that go): the rows of
    ``source`` come, and ``marks`` (``key``, ``partition``, ``_mark``) names the stored rows that go (``OLD_GOES``) and the
    source's that do not come (``NEW_GOES``).  Partitions left with no row are removed.

    Stored rows, new rows and marks are dealt by the partition value once, so a mark meets its row where the row is
    written anyway.  A partition of many rows is dealt in shares of its keys; each share is a file sorted by ``cluster``.
    """
    # partition values are dates: both sets are bounded by the calendar
    touched_list = sorted(new_parts | old_parts, key=str)
    if not touched_list:
        return
    affected = target.filter(_in_partitions(partition, touched_list))
    source = source.select(*target.columns)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sizes: dict = {}
    for df in (affected, source):
        for p, rows in df.groupBy(partition).count().collect():
            sizes[p] = sizes.get(p, 0) + rows
    most = max(ROWS_PER_SHARE, sum(sizes.values()) // n)  # so at most n partitions are larger
    shares = F.lit(1)
    for p, rows in sizes.items():
        if rows > most:
            shares = F.when(F.col(partition).eqNullSafe(F.lit(p)), F.lit(-(-rows // most))).otherwise(shares)
    # a partition is left empty only if it lost a moved key, receives no
    # source row and keeps none of its other rows: check just those
    candidates = sorted(old_parts - new_parts, key=str)
    emptied = []
    if candidates:
        lost = marks.where(F.col("_mark") == OLD_GOES).select(F.col(key).alias("_k"), F.col(partition).alias("_p"))
        among = affected.filter(_in_partitions(partition, candidates))
        still = {r[0] for r in among.join(lost, (F.col(key) == F.col("_k")) & F.col(partition).eqNullSafe(F.col("_p")), "left_anti")
                 .select(partition).distinct().collect()}
        emptied = [p for p in candidates if p not in still]
    sk = [f.name for f in target.schema.fields if f.name.endswith("_sk") and isinstance(f.dataType, T.StringType)]

    def dealt(df: DataFrame, new: bool | None, mark) -> DataFrame:
        columns = [F.col(c) if c in df.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns]
        packs = [packed(F.col(c)).alias(c) if c in sk else v for c, v in zip(target.columns, columns, strict=True)]
        return df.select(*columns, F.lit(new).cast("boolean").alias("_new"), mark.alias("_mark")).select(*packs, "_new", "_mark")

    nothing = F.lit(0)
    every = (dealt(affected, False, nothing).unionByName(dealt(source, True, nothing))
             .unionByName(dealt(marks, None, F.col("_mark"))))
    every = every.withColumn("_share", F.pmod(F.xxhash64(key), shares)).repartition(n, partition, "_share")
    said = F.expr("bit_or(_mark)").over(Window.partitionBy(partition, "_share", key))
    against = F.when(F.col("_new"), F.lit(NEW_GOES)).otherwise(F.lit(OLD_GOES))
    merged = every.withColumn("_said", said).where(F.col("_new").isNotNull() & (F.col("_said").bitwiseAND(against) == 0))
    merged = merged.select(*[unpacked(F.col(c)).alias(c) if c in sk else F.col(c) for c in target.columns])
    # Dynamic overwrite replaces exactly the partitions present in ``merged``.
    # New files go to a staging folder and replace the old ones only at job
    # commit, so tasks (and their retries) still read the old target files.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    merged.sortWithinPartitions(partition, *(cluster or [])).write.mode("overwrite").partitionBy(partition).parquet(target_path)
    for p in emptied:
        _delete(spark, f"{target_path.rstrip('/')}/{partition}={NULL_PARTITION if p is None else p}")
