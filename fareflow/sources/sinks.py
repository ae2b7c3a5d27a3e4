"""Sinks of the model layers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fareflow.operators.incremental import write_partitioned


def as_view(df: DataFrame, name: str) -> DataFrame:
    """S3: view layer: a named, lazily evaluated temp view."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Table layer: full rebuild of a parquet table, read back.

    Reading the written table cuts the lineage: downstream models (and task
    retries after an executor loss) start from the stored files.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """S4 for tables that are joined by ``key`` again and again: a catalog table whose files are dealt by the
    hash of ``key`` and sorted by it.

    The rows are dealt once, when they are stored (a task writes one bucket, one file each); joins and
    aggregations by ``key`` of tables with equally many buckets then need no shuffle.  ``path`` is
    shared storage; the catalog only holds the definition.  ``dealt``: the rows come from a shuffle by ``key``
    and are stored as they lie.
    """
    spark = df.sparkSession
    ((df if dealt else df.repartition(buckets, key)).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


__all__ = ["as_view", "write_table", "write_bucketed", "write_partitioned"]
