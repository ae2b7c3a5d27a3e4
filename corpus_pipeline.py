"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, packing.

Each stage is one operator call over what the stage before kept; its result is written as
Parquet and read back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import stored, table
from fareflow.llm.decontaminate import drop_contaminated
from fareflow.llm.line_dedup import drop_boilerplate
from fareflow.llm.packing import pack_documents
from fareflow.llm.quality import keep_good
from fareflow.llm.queries import GOOD, quality_model
from fareflow.llm.simhash_dedup import drop_near_duplicates


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores as good; the rest go."""
    return keep_good(docs, quality_model(spark, sf_dir), GOOD)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source.  Exact copies count as one page
    here, so that a group of them reaches the next stage with its text."""
    return drop_boilerplate(docs, copies=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs, shingle_words=4, max_distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences."""
    pieces = pack_documents(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier and the tokenizer cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
