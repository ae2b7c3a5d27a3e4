"""Sessions, stored quarantine, report order and history guards."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from fareflow.operators.incremental import merge_by_key
from fareflow.operators.quality import quarantine
from fareflow.operators.scd import scd2_apply, scd2_init
from fareflow.plans.marts import ordered
from fareflow.session import ensure_checkpoint_dir, get_session


def test_session_keeps_its_partition_count(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert get_session().conf.get("spark.sql.shuffle.partitions") == "13"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_merge_keeps_and_moves_rows_without_a_date(spark):
    path = tempfile.mkdtemp(prefix="fareflow-null-") + "/t"
    schema = "k string, d date, v int"
    day = dt.date(2001, 1, 1)
    merge_by_key(spark, path, spark.createDataFrame([("a", None, 1), ("b", None, 1), ("c", day, 1)], schema), "k", "d")
    merge_by_key(spark, path, spark.createDataFrame([("z", None, 2)], schema), "k", "d")
    merge_by_key(spark, path, spark.createDataFrame([("a", day, 3)], schema), "k", "d")
    rows = lambda: sorted((r.k, r.d, r.v) for r in spark.read.parquet(path).collect())
    assert rows() == [("a", day, 3), ("b", None, 1), ("c", day, 1), ("z", None, 2)]
    merge_by_key(spark, path, spark.createDataFrame([("b", day, 4), ("z", day, 4)], schema), "k", "d")  # empties it
    assert rows() == [("a", day, 3), ("b", day, 4), ("c", day, 1), ("z", day, 4)]


def test_quarantine_splits_every_row_once(spark):
    raw = spark.createDataFrame([("1", "5"), ("2", "five"), ("x", "7"), ("4", None)], "id string, amount string")
    good, bad = quarantine(raw, {"id": "bigint", "amount": "bigint"}, "id")
    assert {r.id for r in good.collect()} == {1, 4}
    assert {(r.row_key, r.failed_columns) for r in bad.collect()} == {("2", "amount"), ("x", "id")}


def test_history_rejects_an_earlier_date(spark):
    snap = spark.createDataFrame([(1, "a")], "id int, v string")
    history = scd2_init(snap, dt.datetime(2001, 8, 2))
    with pytest.raises(ValueError):
        scd2_apply(history, snap, "id", ["v"], dt.datetime(2001, 7, 1))


def test_reports_are_read_in_their_order(spark):
    df = spark.createDataFrame([(dt.date(2001, 1, d), c) for d in (1, 2) for c in "ba"], "revenue_date date, city_name string")
    got = [(r.revenue_date.day, r.city_name) for r in ordered(df, "daily_revenue").collect()]
    assert got == [(2, "a"), (2, "b"), (1, "a"), (1, "b")]


def test_relationship_counts_child_rows(spark):
    from fareflow.operators.quality import check_relationship

    child = spark.createDataFrame([(1,), (9,), (9,), (8,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert check_relationship(child, "c", "p", parent, "id").first().violations == 3
    assert check_relationship(child.where(F.col("p") == 1), "c", "p", parent, "id").first().violations == 0
