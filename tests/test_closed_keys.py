"""Keys that vanish at the source, and late rows over more reports than a query keeps."""

import datetime as dt

from fareflow.operators.asof import as_of_join
from fareflow.operators.scd import scd2_apply, scd2_init
from fareflow.streaming import status_stream as S


def day(n):
    return dt.datetime(2001, 1, n)


def test_a_missing_key_is_closed_and_may_come_again(spark):
    def snap(*rows):
        return spark.createDataFrame(list(rows), "id int, v string")

    h = scd2_init(snap((1, "a"), (2, "b")), day(1))
    kept = scd2_apply(h, snap((1, "a")), "id", ["v"], day(2))
    assert sorted((r.id, r.valid_to) for r in kept.collect()) == [(1, None), (2, None)]
    h = scd2_apply(h, snap((1, "c")), "id", ["v"], day(2), close_missing=True)
    h = scd2_apply(h, snap((2, "b"), (1, "c")), "id", ["v"], day(4), close_missing=True)
    got = sorted((r.id, r.v, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in h.collect())
    assert got == [(1, "a", 1, 2, False), (1, "c", 2, None, True), (2, "b", 1, 2, False), (2, "b", 4, None, True)]
    # in between no version is valid
    facts = spark.createDataFrame([(d, 2, day(d)) for d in (1, 2, 3, 4)], "n int, id int, t timestamp")
    assert sorted((r.n, r.v) for r in as_of_join(facts, h, "id", "t", ["v"]).collect()) == [(1, "b"), (2, None), (3, None), (4, "b")]


def test_late_rows_of_all_reports():
    class Query:
        """Keeps its last three reports and ends after ten."""
        n = 0

        def awaitTermination(self, seconds):
            self.n += 2
            return self.n >= 10

        @property
        def recentProgress(self):
            return [{"batchId": i, "stateOperators": [{"numRowsDroppedByWatermark": i}]} for i in range(max(0, self.n - 3), self.n)]

    assert S.finished(Query()) == sum(range(10))
