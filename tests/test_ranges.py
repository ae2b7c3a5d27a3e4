"""Ranks by explicit splitters: no kept copy, ties and nulls, hot groups over several ranges."""

import datetime as dt
import inspect
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.operators import ranking
from fareflow.operators.ranking import global_rank, range_id, rank_within


def test_no_copy_is_kept():
    assert "persist" not in inspect.getsource(ranking)


@pytest.mark.parametrize("bounds", [[], [5], list(range(0, 300, 3)), list(range(500))])
def test_range_id_counts_lower_bounds(spark, bounds):
    rows = [(v,) for v in [None, *range(-3, 520, 7)]]
    got = spark.createDataFrame(rows, "v bigint").select("v", range_id("v", F.array(*map(F.lit, bounds)).cast("array<bigint>")).alias("r")).collect()
    for r in got:
        assert r.r == (-1 if r.v is None else sum(b < r.v for b in bounds))


def values(kind, n, pick):
    if kind == "decimal(20,4)":
        return [Decimal(pick.randint(-50, 50)) / 8 if pick.random() > 0.1 else None for _ in range(n)]
    if kind == "timestamp":
        return [dt.datetime(2020, 1, 1) + dt.timedelta(minutes=pick.randint(0, 90)) if pick.random() > 0.1 else None for _ in range(n)]
    if kind == "double":
        return [pick.choice([0.0, -0.0, 1.5, float("inf"), float("-inf"), float("nan"), None, pick.random()]) for _ in range(n)]
    return [None] * n if kind == "date" else [pick.randint(0, 30) for _ in range(n)]


@pytest.mark.parametrize("kind", ["bigint", "decimal(20,4)", "timestamp", "double", "date"])
@pytest.mark.parametrize("partitions", [1, 3, 200])
def test_ranks_equal_the_window(spark, kind, partitions):
    pick = random.Random(partitions)
    rows = [(i, pick.choice(["hot", "hot", "hot", "b", None, f"g{i}"]), v) for i, v in enumerate(values(kind, 400, pick))]
    df = spark.createDataFrame(rows, f"id bigint, g string, v {kind}").repartition(5)
    order = F.col("v").desc_nulls_last()
    for got, window in ((global_rank(df, "v", "r", partitions), Window.orderBy(order)),
                        (rank_within(df, ["g"], ["v"], "r", partitions), Window.partitionBy("g").orderBy(order)),
                        (rank_within(df, ["g"], ["v", "id"], "r", partitions), Window.partitionBy("g").orderBy(order, F.col("id").desc_nulls_last()))):
        want = {r.id: r.r for r in df.select("id", F.rank().over(window).alias("r")).collect()}
        assert {r.id: r.r for r in got.collect()} == want
        assert got.columns == ["id", "g", "v", "r"]


def test_empty_and_untyped(spark):
    empty = spark.createDataFrame([], "id bigint, g string, v bigint")
    assert global_rank(empty, "v").collect() == [] and rank_within(empty, ["g"], ["v"]).collect() == []
    with pytest.raises(TypeError):
        global_rank(empty.withColumn("s", F.lit("x")), "s")


def test_a_hot_group_spans_ranges(spark):
    """Of 20,000 rows in one group no window partition holds more than a small part."""
    df = spark.range(20_000).select("id", F.lit("hot").alias("g"), (F.col("id") * 7919 % 10_007).alias("v"))
    plan = rank_within(df, ["g"], ["v"], "r", 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "_range" in plan
    bounds = ranking._splitters(df, "v", 16, ["g"]).first()["_bounds"]
    sizes = [r["count"] for r in df.groupBy(range_id("v", F.array(*map(F.lit, bounds)))).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16
