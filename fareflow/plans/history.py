"""Incremental fact loads and dimension history on the model graph."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.operators.incremental import merge_by_key, new_rows, shared_table_path
from fareflow.operators.asof import as_of_join
from fareflow.operators.joins import hot_keys
from fareflow.operators.keyed import merge_keyed
from fareflow.operators.scd import current_versions, scd2_apply, scd2_init
from fareflow.plans import intermediate, marts

FACT_KEY = "trip_sk"
FACT_PARTITION = "trip_date"
FACT_CLUSTER = ["city_sk", "driver_sk"]
# First run of the two-run incremental scenario: trips created before this day.
FIRST_RUN_BEFORE = dt.datetime(1998, 1, 1)
# Earlier dimension snapshot of the history scenario.
SNAPSHOT_AS_OF = dt.date(2001, 7, 1)
DRIVER_TRACKED = ["driver_status", "driver_tier", "rating_category", "driver_health_status"]


def build_fact(m, trips: DataFrame, *more: str) -> DataFrame:
    return marts.fact_trips(trips, m.dim_drivers, m.dim_riders, m.dim_cities, m.config.as_of,
                            m.config.broadcast_max_rows, m.driver_hot_keys, m.rider_hot_keys, more)


def load_fact(m, target_path: str, watermark_col: str = "created_at", inclusive: bool = False) -> DataFrame:
    """One incremental run: delta above the watermark -> fact rows -> merge."""
    delta = new_rows(m.trip_grain, target_path, watermark_col, inclusive)
    fact = build_fact(m, delta)
    merge_keyed(m.spark, target_path, fact, FACT_KEY, FACT_PARTITION, FACT_CLUSTER, F.struct("updated_at"))
    return fact


def _two_run_target(m) -> tuple[str, DataFrame]:
    """Run 1 loads trips created before FIRST_RUN_BEFORE; run 2 takes the rest."""
    path = shared_table_path(m.spark, "fact_trips")
    first = m.trip_grain.filter(F.col("created_at") < F.lit(FIRST_RUN_BEFORE).cast("timestamp"))
    merge_by_key(m.spark, path, build_fact(m, first), FACT_KEY, FACT_PARTITION, FACT_CLUSTER)
    delta = new_rows(m.trip_grain, path, "created_at")
    return path, delta


def incremental_delta(m) -> DataFrame:
    """The fact rows the second run adds (created_at above the first run's max)."""
    _, delta = _two_run_target(m)
    return build_fact(m, delta)


def merge_by_key_q(m) -> DataFrame:
    """The fact table after both runs, read back from its partitioned files."""
    path, delta = _two_run_target(m)
    merge_by_key(m.spark, path, build_fact(m, delta), FACT_KEY, FACT_PARTITION, FACT_CLUSTER)
    cols = m.fact_trips.columns
    return m.spark.read.parquet(path).select(*cols)


def merge_null_date(m) -> DataFrame:
    """I1 with rows of no date: every 7th trip is first stored without one; of these the even ones then move
    to their date, and every third trip comes again, the odd 7th ones still without a date."""
    return _null_dates(m, merge_by_key)


def merge_null_date_keyed(m) -> DataFrame:
    """``merge_null_date`` with the key index: the moved keys are found without reading the fact."""
    return _null_dates(m, merge_keyed)


def _null_dates(m, merge) -> DataFrame:
    path = shared_table_path(m.spark, "fact_trips_null")
    undated = (F.col("trip_id") % 7 == 0)
    first = m.fact_trips.withColumn("trip_date", F.when(~undated, F.col("trip_date")))
    merge(m.spark, path, first, FACT_KEY, FACT_PARTITION, FACT_CLUSTER)
    still = undated & (F.col("trip_id") % 2 == 1)
    again = (m.fact_trips.filter((F.col("trip_id") % 14 == 0) | (F.col("trip_id") % 3 == 0))
             .withColumn("trip_date", F.when(~still, F.col("trip_date"))))
    merge(m.spark, path, again, FACT_KEY, FACT_PARTITION, FACT_CLUSTER)
    return m.spark.read.parquet(path).select(*m.fact_trips.columns)


def driver_snapshot(m, as_of: dt.date) -> DataFrame:
    """Driver attributes as known on ``as_of`` (only trips requested before it)."""
    trips = m.stg_trips.filter(F.col("requested_at") < F.lit(dt.datetime(as_of.year, as_of.month, as_of.day))
                               .cast("timestamp"))
    dm = intermediate.driver_metrics(trips, m.stg_drivers, m.stg_status_events, as_of)
    return dm.select("driver_id", *DRIVER_TRACKED)


def scd2_history(m) -> DataFrame:
    """Driver history after two snapshots (SNAPSHOT_AS_OF, then as_of)."""
    t0 = dt.datetime(SNAPSHOT_AS_OF.year, SNAPSHOT_AS_OF.month, SNAPSHOT_AS_OF.day)
    h = scd2_init(driver_snapshot(m, SNAPSHOT_AS_OF), t0)
    return scd2_apply(h, driver_snapshot(m, m.config.as_of), "driver_id", DRIVER_TRACKED, m.config.as_of_ts)


def scd2_closed_keys(m) -> DataFrame:
    """I3 with rows deleted at the source: every tenth driver is missing from the second snapshot, which closes its version."""
    t0 = dt.datetime(SNAPSHOT_AS_OF.year, SNAPSHOT_AS_OF.month, SNAPSHOT_AS_OF.day)
    h = scd2_init(driver_snapshot(m, SNAPSHOT_AS_OF), t0)
    left = driver_snapshot(m, m.config.as_of).filter("driver_id % 10 <> 3")
    return scd2_apply(h, left, "driver_id", DRIVER_TRACKED, m.config.as_of_ts, close_missing=True)


# Snapshots of the point-in-time lookup.
HISTORY_DATES = [dt.date(1996, 1, 1), dt.date(1998, 1, 1), dt.date(2000, 1, 1), SNAPSHOT_AS_OF]


def fact_versions_asof(m) -> DataFrame:
    """Every trip with the driver attributes that were valid when it was requested, from a stored
    history of four snapshots; trips before the first have none."""
    path = shared_table_path(m.spark, "driver_versions")
    for day in HISTORY_DATES:
        current, start = driver_snapshot(m, day), dt.datetime(day.year, day.month, day.day)
        done = history_versions(m.spark, path)
        store_history(m.spark, scd2_apply(stored_history(m.spark, path), current, "driver_id", DRIVER_TRACKED, start)
                      if done else scd2_init(current, start), path)
    trips = m.lean().trip_grain.select("trip_id", "driver_id", "requested_at")
    return as_of_join(trips, stored_history(m.spark, path), "driver_id", "requested_at", DRIVER_TRACKED)


# Dimensions kept as type-2 history by ``snapshot`` (tracked attributes).
SNAPSHOT_DIMS = {
    "dim_drivers": ("driver_id", ["driver_status", "driver_tier", "rating_category", "driver_health_status",
                                  "city_id", "rating"]),
    "dim_riders": ("rider_id", ["country_code", "region", "ltv_segment", "rider_status"]),
}


def _folder(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def history_versions(spark, path: str) -> list[str]:
    """The complete stored versions of a history (folders ``v<number>`` with a success mark), oldest first."""
    jvm, root, fs = _folder(spark, path)
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    return [f"{path}/{n}" for n in sorted(names)
            if n[:1] == "v" and n[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]


def stored_history(spark, path: str) -> DataFrame:
    """The newest complete version of a history."""
    return spark.read.parquet(history_versions(spark, path)[-1])


def store_history(spark, history: DataFrame, path: str) -> str:
    """Write ``history`` as a new version.  The version it was computed from stays until the next
    run, so a failure at any point loses nothing: an incomplete version has no success mark."""
    done = history_versions(spark, path)
    number = int(done[-1].rsplit("/v", 1)[1]) + 1 if done else 1
    target = f"{path}/v{number:06d}"
    history.write.mode("overwrite").parquet(target)  # replaces an incomplete try only
    for old in done[:-1]:
        _, p, fs = _folder(spark, old)
        fs.delete(p, True)
    return target


def snapshot(m, warehouse: str, effective_at: dt.datetime | None = None) -> dict[str, str]:
    """Update the type-2 history of each dimension under ``warehouse``.

    The first run stores the current dimension as version one; later runs
    close changed versions and open new ones.  Returns the folders written.
    """
    eff = effective_at or m.config.as_of_ts
    paths = {}
    for name, (key, tracked) in SNAPSHOT_DIMS.items():
        path = f"{warehouse.rstrip('/')}/{name}_history"
        current = m[name].drop("valid_from", "valid_to", "is_current")
        if history_versions(m.spark, path):
            hist = scd2_apply(stored_history(m.spark, path), current, key, tracked, eff)
        else:
            hist = scd2_init(current, eff)
        paths[name] = store_history(m.spark, hist, path)
    return paths


def fact_current_dims(m) -> DataFrame:
    """I4: the fact keyed by the current versions of the stored driver and rider histories, after
    snapshots at SNAPSHOT_AS_OF and at as_of.  All versions of a key share its surrogate key; the
    lookup takes the open one, of which each key has exactly one."""
    from fareflow.plans.pipeline import Models

    root = shared_table_path(m.spark, "histories")
    early = Models(m.spark, m.raw, replace(m.config, as_of=SNAPSHOT_AS_OF))
    snapshot(early, root)
    early.free()
    snapshot(m, root)
    drivers, riders = (current_versions(stored_history(m.spark, f"{root}/{name}_history")) for name in SNAPSHOT_DIMS)
    return marts.fact_trips(m.trip_grain, drivers, riders, m.dim_cities, m.config.as_of, m.config.broadcast_max_rows,
                            m.driver_hot_keys, m.rider_hot_keys)


def fact_hot_lookup(m) -> DataFrame:
    """J7 without broadcast dimensions: a driver or rider with a tenth of all trips is hot (driver 0
    holds 30 % of the test trips), its dimension row joins by broadcast, the rest by a shuffle."""
    return marts.fact_trips(m.trip_grain, m.dim_drivers, m.dim_riders, m.dim_cities, m.config.as_of, 0,
                            hot_keys(m.stg_trips, "driver_id", 10, 1), hot_keys(m.stg_trips, "rider_id", 10, 1))


def incremental_updates(m) -> DataFrame:
    """I1/I2 with the B7 options: the watermark is ``updated_at`` and inclusive,
    so the second run re-reads the rows tied at the first run's maximum and the
    merge by key replaces them in place.  Returns the final table."""
    path = shared_table_path(m.spark, "fact_trips_upd")
    first = m.trip_grain.filter(F.col("updated_at") < F.lit(FIRST_RUN_BEFORE).cast("timestamp"))
    merge_by_key(m.spark, path, build_fact(m, first), FACT_KEY, FACT_PARTITION, FACT_CLUSTER)
    load_fact(m, path, watermark_col="updated_at", inclusive=True)
    return m.spark.read.parquet(path).select(*m.fact_trips.columns)
