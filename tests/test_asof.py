"""The point-in-time lookup against a slow search, and how a hot key is spread."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fareflow.operators.asof import as_of_join

BASE = dt.datetime(2020, 1, 1)
FACTS = "id bigint, k string, t timestamp"
VERSIONS = "k string, valid_from timestamp, valid_to timestamp, v int, w string"


def hour(n):
    return None if n is None else BASE + dt.timedelta(hours=n)


def slow(facts, versions):
    out = []
    for i, k, t in facts:
        best = [(f, to is None, to or BASE, v, w, to) for kk, f, to, v, w in versions if kk == k and k is not None and f is not None and t is not None and f <= t]
        f = max(best)[0] if best else None
        own = max((b for b in best if b[0] == f), key=lambda b: (b[1], b[2], b[3] is not None, b[3] or 0, b[4] or "")) if best else None
        if own and (own[5] is None or t < own[5]):
            out.append((i, k, t, own[3], own[4], own[0], own[5]))
        else:
            out.append((i, k, t, None, None, None, None))
    return sorted(out)


@pytest.mark.parametrize("seed, chunk", [(1, "hour"), (2, "day"), (3, "month")])
def test_as_of_equals_a_search(spark, seed, chunk):
    pick = random.Random(seed)
    versions = []
    for k in "abcd":
        starts = sorted(pick.sample(range(-100, 900), pick.randint(0, 6)))
        for at, start in enumerate(starts):
            end = starts[at + 1] if at + 1 < len(starts) else None
            if pick.random() < 0.3:  # a gap, or an end of the last version
                end = start + 5 if end is None else min(end, start + 5)
            versions.append((k, hour(start), hour(end), pick.choice([None, 1, 2]), f"{k}{start}"))
    versions += [(None, hour(0), None, 1, "x"), ("a", None, None, 1, "x"), ("e", hour(3), None, 1, "x"), ("e", hour(3), None, 7, "y")]
    keys = ["a", "a", "a", "b", "c", "d", "e", "z", None]
    facts = [(i, pick.choice(keys), hour(pick.choice([None, *range(-120, 920)]))) for i in range(300)]
    facts += [(1000 + i, r[0], r[1]) for i, r in enumerate(versions) if r[1]]  # at the very start of a version
    got = as_of_join(spark.createDataFrame(facts, FACTS).repartition(3), spark.createDataFrame(versions, VERSIONS), "k", "t", ["v", "w"], chunk=chunk)
    assert got.columns == ["id", "k", "t", "v", "w", "valid_from", "valid_to"]
    assert sorted(map(tuple, got.collect())) == slow(facts, versions)


def test_empty_sides(spark):
    facts, versions = spark.createDataFrame([(1, "a", BASE)], FACTS), spark.createDataFrame([("a", BASE, None, 1, "x")], VERSIONS)
    none = spark.createDataFrame([], VERSIONS)
    assert [r.v for r in as_of_join(facts, none, "k", "t", ["v"]).collect()] == [None]
    assert as_of_join(facts.limit(0), versions, "k", "t", ["v"]).collect() == []


def test_a_hot_key_and_rows_without_a_key_are_spread(spark):
    """Neither the rows of one key nor those of none meet in one task."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "hot").alias("k"),
                                           (F.lit(BASE) + F.make_dt_interval(F.lit(0), (F.col("id") % 2000).cast("int"))).alias("t"))
        versions = spark.createDataFrame([("hot", BASE, None, 1, "x")], VERSIONS)
        got = as_of_join(facts, versions, "k", "t", ["v"])
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
        assert got.where("v = 1").count() == 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
