"""Reads that differ, and columns named like an operator's own."""

import uuid

import pytest
from pyspark.sql import functions as F

from fareflow.llm import token_counts as T
from fareflow.llm.common import fresh
from fareflow.llm.line_dedup import drop_boilerplate
from fareflow.llm.simhash_dedup import links, near_duplicates


def test_two_reads_that_differ_raise(spark, monkeypatch, tmp_path):
    """Equal numbers of other pre-tokens: the second read of a block sees another text."""
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string").coalesce(1)
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    stored = spark.read.parquet(path)
    assert T.token_counts(stored).count() == 1

    def other_words(frames):  # another text at each evaluation, as a source without order would give
        for frame in frames:
            yield frame.assign(text=[f"w{uuid.uuid4().hex[:12]} b c" for _ in range(len(frame))])

    moving = stored.mapInPandas(other_words, stored.schema)
    with pytest.raises(Exception, match="differ between two reads"):
        T.token_counts(moving).collect()


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "__host int, __KEPT int")
    assert fresh(df, "__host", "__kept", "__other") == ("__host_", "__kept_", "__other")


def test_line_dedup_beside_columns_of_its_own_names(spark):
    rows = [(i, f"own line {i}\nthe same line", "h", f"a{i}", f"b{i}", f"c{i}", 7) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, __host string, __kept string, __boilerplate string, n_chars int")
    got = sorted(map(tuple, drop_boilerplate(docs).collect()))
    assert got == [(i, f"own line {i}", "h", f"a{i}", f"b{i}", f"c{i}", len(f"own line {i}")) for i in range(10)]
    assert drop_boilerplate(docs).columns == docs.columns


def test_keys_of_fingerprints_are_never_broadcast(spark):
    """3,000 fingerprints have some 300,000 keys; the planner's estimate of them lies far below its limit."""
    prints = spark.range(3000).select(F.xxhash64("id").alias("fp"))
    linked = links(prints)
    assert linked.count() == 0
    plan = linked._jdf.queryExecution().executedPlan()
    linked.collect()
    assert "SortMergeJoin" in plan.toString() and "Broadcast" not in plan.toString()
    # rows of one text lie in files far smaller than themselves
    docs = spark.createDataFrame([(i, "one two three four five") for i in range(50)], "doc_id long, text string")
    found = near_duplicates(docs)
    assert [r["component_id"] for r in found.collect()] == [0] * 50
    assert "SortMergeJoin [fp" in found._jdf.queryExecution().executedPlan().toString()
