"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.operators.incremental import shared_table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor never recomputes what came before) and
    gives the planner the true size of the table.
    """
    path = shared_table_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, each with underscores added until no column of ``df`` has it (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return tuple(out)


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null stays null."""
    return F.crc32(F.col(column).cast("string")) % modulus


def partition_id() -> int:
    return TaskContext.get().partitionId()


def tokenizer_file(name: str) -> str:
    """A tokenizer file: a path as given, or the name of a public vocabulary."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def parts(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that a worker holds the Python values of few rows at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's values; null reads as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """``doc_id``, ``label``, ``text`` of a bounded sample: per label the ``per_label`` documents
    of the lowest doc_id hash, one row each.

    ``labels`` has ``doc_id`` and ``label``.  Null ids and labels are left out; of several labels
    of a document the smallest counts; of rows that share a doc_id the one of the smallest text
    hash.  Only ids are ranked; the sample's ids (a bounded table) are broadcast to the documents.
    """
    known = (labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
             .withColumn("hash", F.xxhash64("doc_id")))
    # before ranking, a label's rows are thinned by their hash to about twice the wanted number
    share = F.broadcast(known.groupBy("label").agg((2 * per_label / F.count(F.lit(1))).alias("share")))
    thinned = known.join(share, "label").where(F.pmod("hash", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    lowest = Window.partitionBy("label").orderBy(F.pmod("hash", F.lit(1 << 30)), "doc_id")
    chosen = (thinned.withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= per_label)
              .select("doc_id", "label"))
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    return (rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
            .select("doc_id", "label", F.col("first.text").alias("text")))
