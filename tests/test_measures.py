"""Rules measured while tables are written: no further reading of the raw tables, the results of the suite."""

import tempfile

from pyspark.sql import functions as F

from fareflow.operators.quality import Measures, accepted_rule, not_null_rules
from fareflow.plans.pipeline import Models, materialize
from fareflow.plans.quality_checks import dq_summary

SF = "/root/testdata/sf0.001"


def test_a_measured_run_gives_the_suite(spark):
    m = Models.from_testdata(spark, SF)
    paths, rows = materialize(m, tempfile.mkdtemp(prefix="fareflow-measured-"), measure=True)
    assert {"stg_trips", "stg_payments", "fact_trips", "daily_revenue"} <= set(paths)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, dq_summary(Models.from_testdata(spark, SF)).collect()))
    assert "stg_trips" in m["stg_trips"].inputFiles()[0]  # later models read the stored staging


def test_rules_cost_no_job_of_their_own(spark):
    """The measures are there after the write, and reading them runs no job while all rules pass."""
    measures = Measures()
    df = spark.range(1000).withColumn("status", F.lit("a"))
    path = tempfile.mkdtemp(prefix="fareflow-observe-") + "/t"
    measures.watch(df, "t", [*not_null_rules(["id", "status"]), accepted_rule("status", ["a"])]).write.parquet(path)
    group = "measures-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        rows = measures.rows(spark)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in rows.collect()] == [("t", "not_null", "id", 0, "pass"), ("t", "not_null", "status", 0, "pass"),
                                                  ("t", "accepted_values", "status", 0, "pass")]


def test_counts_that_do_not_fit_the_rows_are_taken_again(spark):
    """A stage that ran twice would count violations twice: the rows it measured then differ from the table's."""
    measures = Measures()
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "x")], "id int, status string")
    watched = measures.watch(df, "t", [*not_null_rules(["id"]), accepted_rule("status", ["a"])])
    watched.unionByName(watched.limit(0)).collect()
    twice = Measures()
    seen = twice.watch(df, "t", [*not_null_rules(["id"]), accepted_rule("status", ["a"])])
    seen.collect()
    own = twice._watched[0][3]

    class Doubled:
        get = {k: 2 * v for k, v in own.get.items()}

    twice._watched[0] = (*twice._watched[0][:3], Doubled())
    assert [r.violations for r in twice.rows(spark).collect()] == [1, 1]
    assert twice.measured("t", "not_null") == 2


def test_null_predicates_are_no_violations(spark):
    measures = Measures()
    measures.watch(spark.createDataFrame([(None,), (1,), (-1,)], "v int"), "t", [("negative", "*", F.col("v") < 0)]).collect()
    assert [tuple(r) for r in measures.rows(spark).collect()] == [("t", "negative", "*", 1, "fail")]


def test_cli_run_measures(spark, capsys):
    from fareflow.__main__ import main

    code = main(["run", "--sf-dir", SF, "--warehouse", tempfile.mkdtemp(prefix="fareflow-measured-"), "--measure"])
    out = capsys.readouterr().out
    assert code == 1  # the raw test data violates declared rules
    assert "daily_revenue\t" in out and "FAIL  not_null" in out and "PASS  unique" in out


def test_references_of_a_table_are_counted_in_one_pass(spark):
    """Several references of a child give the rows of one check each, with nulls and keys of two types, from one scan."""
    from fareflow.operators.quality import check_relationship, check_relationships

    path = tempfile.mkdtemp(prefix="fareflow-references-") + "/child"
    spark.createDataFrame([(1, 7, "x"), (1, None, "y"), (2, 8, None), (3, 7, "z"), (None, 9, "z")], "a long, b int, c string").write.parquet(path)
    child = spark.read.parquet(path)
    parents = [("a", spark.createDataFrame([(1,), (1,), (None,)], "k long"), "k"), ("b", spark.createDataFrame([(7,)], "k int"), "k"),
               ("c", spark.createDataFrame([("x",), ("y",), ("z",)], "k string"), "k")]
    got = check_relationships(child, "t", parents)
    each = [tuple(check_relationship(child, "t", *p).first()) for p in parents]
    assert sorted(map(tuple, got.collect())) == sorted(each) == [("t", "relationships", "a", 2, "fail"), ("t", "relationships", "b", 2, "fail"),
                                                                 ("t", "relationships", "c", 0, "pass")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_queries_of_few_fact_columns_keep_no_wide_copy(spark):
    """The fact's references, merge key and reports over a few of its columns neither keep nor read the whole fact."""
    from fareflow.plans.history import fact_versions_asof
    from fareflow.plans.operator_queries import top10_per_city
    from fareflow.plans.quality_checks import dq_relationships

    m = Models.from_testdata(spark, SF)
    for query in (dq_relationships, top10_per_city, fact_versions_asof):
        query(m)
        assert not {"stg_payments", "trip_grain", "fact_trips"} & set(m._cache), query.__name__
    whole = m.fact_trips
    assert m.lean().fact_trips is whole  # a kept copy is used
    m.free()


def test_a_measured_run_shuffles_trips_and_payments_once_each(spark, monkeypatch):
    """Staging is stored in buckets of the trip: details, analysis, grain and reference check deal neither table again."""
    from fareflow.operators import keyed
    from fareflow.plans import marts

    def refused(*args):
        raise AssertionError("whole rows of unique keys were deduplicated")

    monkeypatch.setattr(keyed, "dedupe_latest", refused)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = Models.from_testdata(spark, SF)
        materialize(m, tempfile.mkdtemp(prefix="fareflow-measured-"), measure=True)
        plan = marts.trip_grain(m["stg_trips"], m["stg_payments"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packed_keys_are_the_same_texts(spark):
    from fareflow.functions.keys import packed, unpacked

    texts = [None, "", "a", "0a", "0A", "abc", "no key", "é", "00ff", "d41d8cd98f00b204e9800998ecf8427e", "D41d8cd98f00b204e9800998ecf8427e", "\x00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p"))
    assert [r[0] for r in rows.select(unpacked(F.col("p"))).collect()] == texts
    assert rows.select("p").distinct().count() == len(texts)
