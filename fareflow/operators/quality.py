"""Data-quality rules as Spark jobs (Q1-Q7).

Every rule yields rows ``(table, rule, column, violations, status)``; a rule
passes when it finds no violating row.  ``not_null`` checks all its columns
of a table in one aggregate pass; the others are one aggregate or one
anti-join each.  ``*_rows`` variants return the violating rows themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.keys import packed

RESULT_COLS = ["table", "rule", "column", "violations", "status"]


def _result(table: str, rule: str, column: str, violations: Column) -> list[Column]:
    v = violations.cast("bigint")
    return [F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.lit(column).alias("column"),
            v.alias("violations"), F.when(v == 0, "pass").otherwise("fail").alias("status")]


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Q1: NULL count per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"_n{i}").alias("n")) for i, c in enumerate(columns)])
    long = counts.select(F.explode(cells).alias("_cell"))
    v = F.col("_cell.n").cast("bigint")
    return long.select(F.lit(table).alias("table"), F.lit("not_null").alias("rule"),
                       F.col("_cell.c").alias("column"), v.alias("violations"),
                       F.when(v == 0, "pass").otherwise("fail").alias("status"))


def check_unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Q2: number of non-NULL key values that occur more than once."""
    value = packed(F.col(key)) if isinstance(df.schema[key].dataType, T.StringType) else F.col(key)
    dup = df.filter(F.col(key).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n")) \
        .filter(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("_v")).select(*_result(table, "unique", key, F.col("_v")))


def check_accepted(df: DataFrame, table: str, column: str, values: Iterable) -> DataFrame:
    """Q3: rows whose non-NULL value is outside ``values``."""
    vals = list(values)
    bad = F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(vals))
    return df.agg(bad.alias("_v")).select(*_result(table, "accepted_values", column, F.col("_v")))


def relationship_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q4: child rows whose non-NULL reference has no parent row (left anti join)."""
    keys = parent.select(F.col(parent_column).alias("_pk")).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_pk"), "left_anti")


def check_relationship(child: DataFrame, table: str, column: str, parent: DataFrame,
                       parent_column: str) -> DataFrame:
    """Rows are counted per key first (in each map task), so a hot key is one row in the anti join."""
    keys = child.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    bad = relationship_rows(keys, column, parent, parent_column)
    return bad.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_v")).select(
        *_result(table, "relationships", column, F.col("_v")))


def check_relationships(child: DataFrame, table: str, references: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """``check_relationship`` for several (column, parent, parent column), the child read once.

    Each row is counted under all its references at once (in each map task), and the keys of all parents
    meet them in one anti join; a reference has a slot of its own."""
    types = {child.schema[column].dataType for column, _, _ in references} | {parent.schema[of].dataType for _, parent, of in references}

    def value(column: str) -> Column:
        if types == {T.StringType()}:
            return packed(F.col(column))
        return F.col(column) if len(types) == 1 else F.col(column).cast("string")

    slots = F.array(*[F.struct(F.lit(i).alias("_slot"), value(column).alias("_key")) for i, (column, _, _) in enumerate(references)])
    keys = (child.select(F.explode(slots).alias("_of")).select("_of.*").where(F.col("_key").isNotNull())
            .groupBy("_slot", "_key").agg(F.count(F.lit(1)).alias("_n")))
    known = [parent.select(F.lit(i).alias("_slot"), value(of).alias("_key")) for i, (_, parent, of) in enumerate(references)]
    parents = known[0]
    for more in known[1:]:
        parents = parents.unionByName(more)
    bad = keys.join(parents, ["_slot", "_key"], "left_anti").groupBy("_slot").agg(F.sum("_n").alias("_v"))
    rules = child.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(column) for column, _, _ in references])).alias("_slot", "column"))
    v = F.coalesce("_v", F.lit(0)).cast("bigint")
    return rules.join(bad, "_slot", "left").select(
        F.lit(table).alias("table"), F.lit("relationships").alias("rule"), "column", v.alias("violations"),
        F.when(v == 0, "pass").otherwise("fail").alias("status"))


def check_expr(df: DataFrame, table: str, name: str, violating: Column) -> DataFrame:
    """Q5: rows matching a violation predicate."""
    return df.agg(F.count_if(F.coalesce(violating, F.lit(False))).alias("_v")).select(
        *_result(table, name, "*", F.col("_v")))


class Measures:
    """Rules measured in the pass that reads or writes a table (Q1, Q3, Q5), by ``DataFrame.observe``.

    ``watch`` gives a DataFrame with the rules attached; whatever job runs it first measures them.
    ``rows`` are the results.  A stage that runs again after a lost executor is measured again, so a
    count of zero is exact and a higher one may be too high.  Tables with violations
    therefore compare their measured rows with a count (for stored tables the file footers' counts),
    and are checked by a pass of their own if these differ.
    """

    def __init__(self):
        self._watched: list[tuple[DataFrame, str, list[tuple[str, str, Column]], Observation]] = []

    def watch(self, df: DataFrame, table: str, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
        """``rules``: (rule, column, violating predicate)."""
        rules = [(rule, column, F.coalesce(bad, F.lit(False))) for rule, column, bad in rules]
        seen = Observation(f"{table}-rules")
        self._watched.append((df, table, rules, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)])

    def measured(self, table: str, rule: str) -> int:
        """Violations of one rule as they were measured."""
        for _, name, rules, seen in self._watched:
            for i, (own, _, _) in enumerate(rules):
                if (name, own) == (table, rule):
                    return seen.get[f"r{i}"]
        raise KeyError((table, rule))

    def rows(self, spark: SparkSession, aside: str | None = None) -> DataFrame:
        """The results of all rules but ``aside``, a rule that marks rows without being a violation."""
        out = []
        for df, table, rules, seen in self._watched:
            own = [(i, r) for i, r in enumerate(rules) if r[0] != aside]
            rules, counts = [r for _, r in own], [seen.get[f"r{i}"] for i, _ in own]
            if any(counts) and seen.get["rows"] != df.count():
                again = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)]).first()
                counts = list(again)
            out += [(table, rule, column, n, "fail" if n else "pass") for (rule, column, _), n in zip(rules, counts, strict=True)]
        return spark.createDataFrame(out, "table string, rule string, column string, violations bigint, status string")


def not_null_rules(columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_rule(column: str, values: Iterable) -> tuple[str, str, Column]:
    return ("accepted_values", column, F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def freshness(df: DataFrame, table: str, loaded_at: str | None, warn_minutes: int, error_minutes: int,
              as_of: dt.datetime) -> DataFrame:
    """Q7: age of the newest ``loaded_at`` against warn / error thresholds.

    A table without the declared column reports ``column missing`` instead
    of failing the job.
    """
    now = F.lit(as_of).cast("timestamp")
    spark = df.sparkSession
    if loaded_at is None or loaded_at not in df.columns:
        return spark.range(1).select(F.lit(table).alias("table"), F.lit(loaded_at).alias("loaded_at_field"),
                                     F.lit(None).cast("timestamp").alias("max_loaded_at"),
                                     F.lit(None).cast("bigint").alias("age_minutes"),
                                     F.lit(warn_minutes).cast("bigint").alias("warn_after_minutes"),
                                     F.lit(error_minutes).cast("bigint").alias("error_after_minutes"),
                                     F.lit("column missing").alias("status"))
    latest = df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at"))
    age = F.timestamp_diff("MINUTE", F.col("max_loaded_at"), now)
    return latest.select(
        F.lit(table).alias("table"), F.lit(loaded_at).alias("loaded_at_field"), "max_loaded_at",
        age.alias("age_minutes"),
        F.lit(warn_minutes).cast("bigint").alias("warn_after_minutes"),
        F.lit(error_minutes).cast("bigint").alias("error_after_minutes"),
        F.when(F.col("max_loaded_at").isNull(), "no data")
         .when(age > error_minutes, "error")
         .when(age > warn_minutes, "warn")
         .otherwise("pass").alias("status"))


def quarantine(df: DataFrame, casts: dict[str, str], key: str) -> tuple[DataFrame, DataFrame]:
    """Q6: split rows that cast cleanly from rows that would fail a cast.

    A value fails when it is not NULL but ``try_cast`` gives NULL.  Returns
    ``(good, bad)``: ``good`` with the casts applied, ``bad`` as
    ``(key, failed_columns)`` plus the raw row, for a quarantine table.
    With strict (ANSI) casts the whole job would fail on the first bad value.
    """
    fails = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in casts.items()]
    failed = F.concat_ws(",", *fails)
    marked = df.withColumn("_failed", failed)
    good = marked.filter(F.col("_failed") == "").drop("_failed").select(
        *[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])
    bad = marked.filter(F.col("_failed") != "").select(F.col(key).cast("string").alias("row_key"),
                                                        F.col("_failed").alias("failed_columns"), *df.columns)
    return good, bad
