"""Versioned merge with a key index: what it reads, which copy stays, and what a failure leaves."""

import datetime as dt
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from fareflow.operators import keyed
from fareflow.operators.keyed import index_path, merge_keyed
from fareflow.plans.pipeline import Models
from fareflow.streaming import status_stream as S

SCHEMA = "k string, d date, v int, t int, gone boolean"
COLUMNS = ["k", "d", "v", "t"]
SF = "/root/testdata/sf0.001"


def day(n):
    return None if n is None else dt.date(2001, 1, n)


def merge(spark, path, rows, **options):
    source = spark.createDataFrame([(k, day(d), v, t, g) for k, d, v, t, g in rows], SCHEMA)
    options = {"version": F.struct("t"), "deleted": F.col("gone"), "columns": COLUMNS, "buckets": 3} | options
    merge_keyed(spark, path, source, "k", "d", **options)


def table(spark, path):
    return sorted(((r.k, r.d.day if r.d else None, r.v, r.t) for r in spark.read.schema("k string, v int, t int, d date").parquet(path).collect()), key=repr)


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="fareflow-keyed-") + "/t"


def test_the_latest_version_stays_whichever_merge_brings_it(spark, path):
    merge(spark, path, [("a", 5, 1, 50, False), ("b", 1, 1, 10, None)])
    merge(spark, path, [("a", 2, 2, 20, False), ("b", 3, 2, 30, False)])  # the older a is ignored, b moves
    assert table(spark, path) == [("a", 5, 1, 50), ("b", 3, 2, 30)]
    merge(spark, path, [("a", 5, 9, 50, False), ("c", 3, 1, 1, False), ("c", 4, 2, 2, False)])  # equal: repeated; two copies in one merge
    assert table(spark, path) == [("a", 5, 9, 50), ("b", 3, 2, 30), ("c", 4, 2, 2)]


def test_deleted_keys_do_not_come_back(spark, path):
    merge(spark, path, [("a", 1, 1, 10, False), ("b", 1, 1, 10, False)])
    merge(spark, path, [("a", None, None, 20, True), ("z", None, None, 5, True)])
    merge(spark, path, [("a", 2, 3, 15, False), ("z", 2, 3, 4, False)])
    assert table(spark, path) == [("b", 1, 1, 10)]
    merge(spark, path, [("a", 2, 4, 30, False)])
    assert table(spark, path) == [("a", 2, 4, 30), ("b", 1, 1, 10)]


def test_a_table_may_begin_with_deleted_keys_only(spark, path):
    merge(spark, path, [("a", None, None, 20, True)])
    merge(spark, path, [("a", 2, 3, 15, False), ("b", 2, 3, 15, False)])
    assert table(spark, path) == [("b", 2, 3, 15)]


def test_random_merges_equal_the_batch_result(spark, path):
    """Copies of 12 keys dealt over merges in any order: the highest version of each key, or nothing if it is deleted."""
    pick = random.Random(3)
    rows = [(f"k{n}", pick.choice([None, 1, 2, 3]), i, 100 * n + i, pick.random() < 0.2) for n in range(12) for i in range(pick.randint(1, 5))]
    best = {}
    for r in rows:
        if r[0] not in best or r[3] > best[r[0]][3]:
            best[r[0]] = r
    pick.shuffle(rows)
    for at in range(0, len(rows), 9):
        merge(spark, path, rows[at:at + 9])
    assert table(spark, path) == sorted((r[:4] for r in best.values() if not r[4]), key=repr)


def test_a_table_without_an_index_gets_one(spark, path):
    from fareflow.operators.incremental import merge_by_key

    merge_by_key(spark, path, spark.createDataFrame([("a", day(1), 1, 10), ("b", day(2), 1, 10)], "k string, d date, v int, t int"), "k", "d")
    assert index_path(spark, path) is None
    merge(spark, path, [("a", 3, 2, 5, False)])  # its version is not known yet: any counts
    assert table(spark, path) == [("a", 3, 2, 5), ("b", 2, 1, 10)]
    merge(spark, path, [("a", 1, 3, 4, False)])
    assert table(spark, path) == [("a", 3, 2, 5), ("b", 2, 1, 10)]


def test_merging_without_versions_keeps_those_of_the_index(spark, path):
    merge(spark, path, [("a", 1, 1, 50, False)])
    merge(spark, path, [("a", 2, 2, 0, False)], version=None)
    merge(spark, path, [("a", 3, 3, 40, False)])  # older than what the index knows
    assert table(spark, path) == [("a", 2, 2, 0)]


def test_a_failure_between_table_and_index_leaves_no_second_row(spark, path, monkeypatch):
    merge(spark, path, [("a", 1, 1, 10, False), ("b", 1, 1, 10, False)])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "_write_index", fail)
        with pytest.raises(OSError):
            merge(spark, path, [("a", 2, 2, 20, False)])
    assert table(spark, path) == [("a", 2, 2, 20), ("b", 1, 1, 10)]  # the table is ahead of its index
    merge(spark, path, [("a", 3, 3, 30, False)])  # another merge than the failed one
    assert table(spark, path) == [("a", 3, 3, 30), ("b", 1, 1, 10)]
    merge(spark, path, [("a", 2, 2, 20, False)])  # the failed one again: too old by now
    assert table(spark, path) == [("a", 3, 3, 30), ("b", 1, 1, 10)]


def test_only_touched_partitions_of_the_table_are_read(spark, path, monkeypatch):
    """The old partition of a moved key comes from the index: other days' files are not opened (they are broken here),
    and of the index only the key's bucket is."""
    import glob
    import os

    merge(spark, path, [(f"k{i}", 1 + i % 9, i, 10, False) for i in range(90)], buckets=16)
    key = "k4"  # on day 5
    own = spark.createDataFrame([(key,)], "k string").select(keyed._bucket("k", 16)).first()[0]
    for file in glob.glob(f"{path}/d=*/*.parquet") + glob.glob(f"{path}_keys/*/_bucket=*/*.parquet"):
        if "d=2001-01-05" not in file and "d=2001-01-07" not in file and f"_bucket={own}/" not in file:
            with open(file, "wb") as f:
                f.write(b"broken")
            crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    merge(spark, path, [(key, 7, 99, 20, False)])
    own_days = spark.read.schema("k string, v int, t int, d date").parquet(path).where("d IN (DATE '2001-01-05', DATE '2001-01-07')")
    assert {(r.k, r.d.day) for r in own_days.collect()} == {(f"k{i}", 1 + i % 9) for i in range(90) if i % 9 in (4, 6) and i != 4} | {(key, 7)}


def test_stale_trips_in_any_order(spark):
    """The parts of the registered query in other orders give the same fact."""
    m = Models.from_testdata(spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    want = m.fact_trips.where("trip_id % 89 <> 0").select("trip_id", "updated_at", "trip_date", "gross_revenue", "trip_status")
    want = sorted(map(repr, want.collect()))
    for order in ((2, 1, 0), (1, 2, 0)):
        folder = tempfile.mkdtemp(prefix="fareflow-orders-")
        parts = S.shuffled_copies(orders)
        for number in order:
            parts[number].write.parquet(f"{folder}/part{number}")
            S.fact_stream(spark, S.read_stream(spark, f"{folder}/part*", "*.parquet", orders.schema), m, folder + "/fact")
        got = spark.read.parquet(folder + "/fact").select("trip_id", "updated_at", "trip_date", "gross_revenue", "trip_status")
        assert sorted(map(repr, got.collect())) == want


def test_only_keys_are_looked_up_where_every_row_counts(spark, path, monkeypatch):
    """Without versions, and in a first merge, the rows themselves go into no join before they are written."""
    seen = []
    for name in ("write_partitioned", "replace_rows"):
        def spy(*args, _own=getattr(keyed, name), _rows=0 if name == "write_partitioned" else 3):
            seen.append(args[_rows]._jdf.queryExecution().analyzed().toString())
            return _own(*args)
        monkeypatch.setattr(keyed, name, spy)
    merge(spark, path, [("a", 5, 1, 50, False), ("b", 1, 1, 10, False)], version=None)
    merge(spark, path, [("a", 2, 2, 20, False), ("b", None, 2, 30, True), ("c", 3, 1, 1, False)], version=None)
    assert table(spark, path) == [("a", 2, 2, 20), ("c", 3, 1, 1)]
    assert len(seen) == 2 and not any("Join" in plan for plan in seen)


def test_index_is_written_without_a_shuffle_of_its_own(spark, path):
    """A bucket of the index is written by all tasks that have rows of it, not by one."""
    rows = spark.range(0, 400, 1, 4).selectExpr("id AS k", "date_add(DATE'2020-01-01', CAST(id % 3 AS INT)) AS d", "id AS v")
    keyed.merge_keyed(spark, path, rows, "k", "d")
    index = spark.read.parquet(keyed.index_path(spark, path))
    assert index.where("_bucket = 0").count() == index.select("k").distinct().count() == 400
    assert len(index.inputFiles()) == 4


def test_stored_rows_are_shuffled_once_in_a_merge(spark, path, monkeypatch):
    """Rows that stay are dealt to the writing tasks and go into no join before, in merges with versions or without."""
    import glob

    days = "date_add(DATE'2020-01-01', CAST(id % 3 AS INT)) AS d"
    rows = spark.range(0, 3000, 1, 4).selectExpr("md5(CAST(id AS STRING)) AS k_sk", days, "repeat(md5(CAST(-id AS STRING)), 8) AS v", "1 AS t")
    again = spark.range(0, 30, 1, 1).selectExpr("md5(CAST(id AS STRING)) AS k_sk", days, "'new' AS v", "2 AS t")
    written = []

    def spy(*args, _own=keyed.replace_rows):
        written.append(args[3]._jdf.queryExecution().analyzed().toString())
        return _own(*args)

    monkeypatch.setattr(keyed, "replace_rows", spy)
    plans = []

    def sorted_rows(df, *cols, _own=type(rows).sortWithinPartitions):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return _own(df, *cols)

    monkeypatch.setattr(type(rows), "sortWithinPartitions", sorted_rows)
    for version in (None, F.struct("t")):
        target = f"{path}{version is None}"
        merge_keyed(spark, target, rows, "k_sk", "d", version=version, unique=True)
        plans.clear()
        merge_keyed(spark, target, again, "k_sk", "d", version=version, unique=True)
        stored = spark.read.parquet(target)
        assert stored.count() == 3000 and stored.where("v = 'new'").count() == 30
        # the kept key lookup is a physical plan here (SortMergeJoin)
        assert not re.search(r"\WJoin ", plans[-1]) and plans[-1].count("RepartitionByExpression") == 1
    assert len(written) == 2 and not any("Join" in plan for plan in written)
    assert not glob.glob(f"{path}*_pending/*")


def test_late_copies_are_left_out_where_they_would_be_written(spark, path):
    """A late copy of one key beside a new row of the same day, and a key that a failed first merge had announced."""
    merge(spark, path, [("a", 5, 1, 50, False), ("b", 1, 1, 10, None)])
    merge(spark, path, [("a", 3, 2, 20, False), ("b", 3, 2, 30, False), ("c", 4, 1, 1, True)])
    assert table(spark, path) == [("a", 5, 1, 50), ("b", 3, 2, 30)]
    index = spark.read.parquet(index_path(spark, path))
    assert sorted((r.k, r._place, r._version.t) for r in index.collect()) == [("a", "2001-01-05", 50), ("b", "2001-01-03", 30), ("c", None, 1)]


def test_many_rows_of_a_partition_are_dealt_in_shares(spark, path, monkeypatch):
    from fareflow.operators import incremental

    monkeypatch.setattr(incremental, "ROWS_PER_SHARE", 40)
    monkeypatch.setattr(spark.conf, "get", lambda name, *a, own=spark.conf.get: "64" if name == "spark.sql.shuffle.partitions" else own(name, *a))
    rows = [(f"k{i}", None if i % 2 else 1, i, 1, False) for i in range(400)]
    merge(spark, path, rows)
    merge(spark, path, [(k, 2 if v % 40 == 0 else d, -v, 2, v % 40 == 7) for k, d, v, *_ in rows if v % 5 < 3])
    want = [(k, day(2 if v % 40 == 0 else d).day if d or v % 40 == 0 else None, -v, 2) if v % 5 < 3 else (k, d, v, 1)
            for k, d, v, *_ in rows if v % 5 >= 3 or v % 40 != 7]
    assert table(spark, path) == sorted(want, key=repr)
