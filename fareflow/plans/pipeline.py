"""The model graph: raw -> staging -> intermediate -> marts, built lazily.

``Models`` resolves each model on first use and memoises the DataFrame, the
way the warehouse resolves ``ref``s: plain Python calls in dependency order,
no scheduler.  Building a model runs no job but the row counts that prove a
dimension small enough to broadcast; Catalyst sees each output as one plan and
prunes what the output does not need.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession

from fareflow.operators.joins import hot_keys

from fareflow.plans import intermediate, marts, staging
from fareflow.session import PipelineConfig
from fareflow.sources.adapter import raw_tables_from_testdata


class Models:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame],
                 config: PipelineConfig | None = None):
        self.spark = spark
        self.raw = raw
        self.config = config or PipelineConfig()
        self._cache: dict[str, DataFrame] = {}
        self.extra_sources: dict[str, str] = {}
        self._lent: set[str] = set()  # models kept by another graph

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str,
                      config: PipelineConfig | None = None) -> "Models":
        m = cls(spark, raw_tables_from_testdata(spark, sf_dir), config)
        m.extra_sources["sf_dir"] = sf_dir
        return m

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = BUILDERS[name](self)
            if name in SHARED and self.config.reuse:
                df = _keep(df)
            self._cache[name] = df
        return self._cache[name]

    def lean(self) -> "LeanModels":
        """The same models for a query that reads few columns of the fact."""
        return LeanModels(self)

    def free(self) -> None:
        """Drop the kept copies; a later use computes the model again.  Copies of another graph stay."""
        for name, df in self._cache.items():
            if name not in self._lent:
                df.unpersist()

    def run_of_its_own(self) -> "Models":
        """A graph for a full run on this one's staging, which is neither computed again nor dropped by the run."""
        run = Models(self.spark, dict(self.raw), self.config)
        run._cache.update({name: self[name] for name in VIEWS})
        run._lent.update(VIEWS)
        return run

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BUILDERS:
            raise AttributeError(name)
        return self[name]


class LeanModels(Models):
    """The graph of a query that reads few columns of the fact: what stands between staging and these columns
    is not kept whole but pruned by Catalyst to what the query reads.  Copies that are kept already are
    used, and all other models are those of the whole graph."""

    def __init__(self, models: Models):
        super().__init__(models.spark, models.raw, models.config)
        self._whole = models

    def __getitem__(self, name: str) -> DataFrame:
        if name not in PRUNED or name in self._whole._cache:
            return self._whole[name]
        if name not in self._cache:
            self._cache[name] = BUILDERS[name](self)
        return self._cache[name]


# Models read by several downstream models in one run: computed once and kept
# (the table layer of the model graph).  A persisted block lost with its
# executor is recomputed from lineage.
SHARED = {"stg_trips", "stg_payments", "stg_drivers", "stg_riders", "stg_cities", "stg_status_events",
          "driver_metrics", "rider_metrics", "trip_grain", "fact_trips",
          # hot-key sets: at most max_keys rows each, read by several joins
          "trip_hot_keys", "driver_hot_keys", "rider_hot_keys"}

# Of these, the wide ones that a lean graph prunes instead of keeping them whole.
PRUNED = {"stg_payments", "trip_grain", "fact_trips"}


def _keep(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# Staging models: the function and its raw table.
STAGED = {
    "stg_trips": (staging.stg_trips, "trips_raw"),
    "stg_drivers": (staging.stg_drivers, "drivers_raw"),
    "stg_riders": (staging.stg_riders, "riders_raw"),
    "stg_payments": (staging.stg_payments, "payments_raw"),
    "stg_cities": (staging.stg_cities, "cities_raw"),
    "stg_status_events": (staging.stg_status_events, "driver_status_events_raw"),
}


def _staging_input(m: "Models", raw_name: str, raw: DataFrame) -> DataFrame:
    if not m.config.strict_casts:
        from fareflow.operators.quality import quarantine
        from fareflow.plans.quality_checks import STAGING_CASTS, UNIQUE
        raw = quarantine(raw, STAGING_CASTS[raw_name], UNIQUE[raw_name])[0]
    return raw


def _stg(name: str):
    fn, raw_name = STAGED[name]
    return lambda m: fn(_staging_input(m, raw_name, m.raw[raw_name]))


BUILDERS: dict[str, Callable[[Models], DataFrame]] = {
    "stg_trips": _stg("stg_trips"),
    "stg_drivers": _stg("stg_drivers"),
    "stg_riders": _stg("stg_riders"),
    "stg_payments": _stg("stg_payments"),
    "stg_cities": _stg("stg_cities"),
    "stg_status_events": _stg("stg_status_events"),
    "trip_hot_keys": lambda m: intermediate.trip_hot_keys(m.stg_payments),
    "int_trip_details": lambda m: intermediate.int_trip_details(m.stg_trips, m.stg_payments, m.trip_hot_keys),
    "int_payment_analysis": lambda m: intermediate.int_payment_analysis(m.stg_payments, m.stg_trips,
                                                                        m.trip_hot_keys),
    "int_driver_activity": lambda m: intermediate.int_driver_activity(m.stg_status_events),
    "driver_trip_stats": lambda m: intermediate.driver_trip_stats(m.stg_trips),
    "status_event_counts": lambda m: intermediate.status_event_counts(m.stg_status_events),
    "driver_metrics": lambda m: intermediate.driver_metrics(m.stg_trips, m.stg_drivers, m.stg_status_events,
                                                            m.config.as_of),
    "rider_trip_stats": lambda m: intermediate.rider_trip_stats(m.stg_trips),
    "rider_metrics": lambda m: intermediate.rider_metrics(m.stg_trips, m.stg_riders, m.config.as_of),
    "payments_reliability": lambda m: marts.payments_reliability(m.stg_payments),
    # dimensions are read by the fact and three reports: computed once, kept
    # (persist is recomputed from lineage if an executor is lost)
    "dim_cities": lambda m: _keep(marts.dim_cities(m.stg_cities, m.config.as_of)),
    "dim_drivers": lambda m: _keep(marts.dim_drivers(m.driver_metrics, m.config.as_of)),
    "dim_riders": lambda m: _keep(marts.dim_riders(m.rider_metrics, m.config.as_of)),
    "dim_dates": lambda m: marts.dim_dates(m.spark),
    "trip_calendar": lambda m: marts.trip_calendar(m.stg_trips),
    "driver_hot_keys": lambda m: hot_keys(m.stg_trips, "driver_id"),
    "rider_hot_keys": lambda m: hot_keys(m.stg_trips, "rider_id"),
    "trip_grain": lambda m: marts.trip_grain(m.stg_trips, m.stg_payments),
    "fact_trips": lambda m: marts.fact_trips(m.trip_grain, m.dim_drivers, m.dim_riders, m.dim_cities,
                                             m.config.as_of, m.config.broadcast_max_rows,
                                             m.driver_hot_keys, m.rider_hot_keys),
    "daily_revenue": lambda m: marts.daily_revenue(m.fact_trips, m.dim_cities, m.config.broadcast_max_rows),
    "drivers_leaderboard": lambda m: marts.drivers_leaderboard(m.fact_trips, m.dim_drivers, m.dim_cities,
                                                               m.config.as_of,
                                                               broadcast_max_rows=m.config.broadcast_max_rows),
    "fraud_monitoring": lambda m: marts.fraud_monitoring(m.fact_trips, m.dim_cities, m.dim_drivers, m.dim_riders,
                                                         m.config.as_of,
                                                         broadcast_max_rows=m.config.broadcast_max_rows),
}


# Layers of a full run and how each model is materialised.
VIEWS = ["stg_trips", "stg_drivers", "stg_riders", "stg_payments", "stg_cities", "stg_status_events"]
TABLES = ["int_trip_details", "int_payment_analysis", "int_driver_activity", "driver_metrics", "rider_metrics",
          "dim_cities", "dim_drivers", "dim_riders", "dim_dates", "trip_grain"]
REPORTS = ["daily_revenue", "drivers_leaderboard", "fraud_monitoring", "payments_reliability"]


def _store_staging(models: Models, root: str, measures) -> dict[str, int]:
    """Staging as stored tables, the raw tables' rules measured in the same pass.  Returns the keys that
    staging's dedup kept of each raw table.  Trips (which the dedup deals by their id) and payments are stored in
    buckets of the trip, by which details, analysis, grain and reference check join them."""
    from fareflow.plans.quality_checks import raw_rules
    from fareflow.sources.sinks import write_bucketed, write_table

    kept, buckets = {}, int(models.spark.conf.get("spark.sql.shuffle.partitions"))
    for name, (fn, raw_name) in STAGED.items():
        kept[raw_name] = Observation(f"{raw_name}-kept")
        raw = measures.watch(models.raw[raw_name], raw_name, raw_rules(raw_name))
        table = fn(_staging_input(models, raw_name, raw), kept[raw_name])
        if name in ("stg_trips", "stg_payments"):
            own = f"{name}_{uuid.uuid4().hex}"  # its name in the catalog
            models._cache[name] = write_bucketed(table, own, f"{root}/{name}", "trip_id", buckets, dealt=name == "stg_trips")
        else:
            models._cache[name] = write_table(table, f"{root}/{name}")
    return {raw: seen.get["n"] for raw, seen in kept.items()}


def materialize(models: Models, warehouse: str, measure: bool = False):
    """One full run: views, then tables, then the incremental fact, then reports.

    Every table is written under ``warehouse`` and read back, so later
    models start from stored files; the fact is merged by key into its
    date-partitioned table (first run = full load).  Returns name -> path.

    With ``measure`` staging is stored as tables as well, and the declared rules are measured while the
    tables are written: returns (name -> path, rule results as in ``dq_summary``).
    """
    from fareflow.operators.quality import Measures
    from fareflow.plans.history import load_fact
    from fareflow.plans.quality_checks import measured_summary, trip_rules
    from fareflow.sources.sinks import as_view, write_table

    paths: dict[str, str] = {}
    root = warehouse.rstrip("/")
    measures, keys = Measures(), {}
    if not models.config.strict_casts:  # the rows that staging leaves out are stored, never thrown away
        from fareflow.plans.quality_checks import quarantined_rows
        paths["quarantine"] = f"{root}/quarantine"
        write_table(quarantined_rows(models), paths["quarantine"])
    if measure:
        keys = _store_staging(models, root, measures)
        paths |= {name: f"{root}/{name}" for name in VIEWS}
    for name in VIEWS:
        as_view(models[name], name)
    for name in TABLES:
        paths[name] = f"{root}/{name}"
        table = models[name]
        if measure and name == "int_trip_details":
            table = measures.watch(table, "trips", trip_rules())
        stored = write_table(table, paths[name])
        models._cache[name].unpersist()  # later models read the stored table
        models._cache[name] = stored
    paths["fact_trips"] = f"{root}/fact_trips"
    load_fact(models, paths["fact_trips"])
    cols = BUILDERS["fact_trips"](models).columns
    models._cache["fact_trips"] = models.spark.read.parquet(paths["fact_trips"]).select(*cols)
    for name in REPORTS:
        paths[name] = f"{root}/{name}"
        models._cache[name] = write_table(models[name], paths[name])
    models.free()
    return (paths, measured_summary(models, measures, keys)) if measure else paths


def read_report(spark: SparkSession, warehouse: str, report: str) -> DataFrame:
    """O1: a stored report in its published order (a stored table keeps none)."""
    return marts.ordered(spark.read.parquet(f"{warehouse.rstrip('/')}/{report}"), report)
