"""Command line: ``python -m fareflow <command> (--landing DIR | --sf-dir DIR) [--warehouse DIR] [--as-of DATE]``.

``--landing`` holds the six landing tables, one folder of Parquet files each, named like the table
(``trips_raw``, ...); ``--sf-dir`` derives them from the test data.

run        full run of the model graph into ``--warehouse`` (views, tables, fact merge, reports); with
           ``--measure`` staging is stored too and the data-quality rules are measured meanwhile
report     print a stored report (``--report NAME``) in its published order
snapshot   update the type-2 history of the driver and rider dimensions
test       the declared data-quality rules; exit code 1 when a rule fails
freshness  source freshness against warn / error thresholds
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def _report(rules) -> int:
    """Print the rule results; 1 if one failed."""
    rows = rules.collect()
    for r in rows:
        print(f"{r['status'].upper():5} {r['rule']:16} {r['table']}.{r['column']}  violations={r['violations']}")
    return 1 if any(r["status"] != "pass" for r in rows) else 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fareflow")
    ap.add_argument("command", choices=["run", "report", "snapshot", "test", "freshness"])
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--landing", help="folder of the six landing tables")
    source.add_argument("--sf-dir", help="folder of the test-data parquet tables")
    ap.add_argument("--report", default="daily_revenue")
    ap.add_argument("--warehouse", help="output folder (shared storage on a cluster)")
    ap.add_argument("--as-of", help="evaluation date YYYY-MM-DD (default 2001-08-02)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--measure", action="store_true", help="run: measure the data-quality rules while the tables are written")
    ap.add_argument("--tune", action="store_true", help="size shuffles and splits from the input size")
    args = ap.parse_args(argv)

    from fareflow.plans import quality_checks
    from fareflow.plans.pipeline import Models, materialize, read_report
    from fareflow.session import DEFAULT_AS_OF, PipelineConfig, get_session
    from fareflow.sources.raw import RAW_SCHEMAS, read_raw

    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else DEFAULT_AS_OF
    spark = get_session(args.master)
    if args.tune:
        from fareflow.session import input_bytes, tune_for_input
        print("shuffle partitions:", tune_for_input(spark, input_bytes(spark, [args.landing or args.sf_dir])))
    config = PipelineConfig(as_of=as_of)
    if args.landing:
        m = Models(spark, {t: read_raw(spark, t, f"{args.landing.rstrip('/')}/{t}") for t in RAW_SCHEMAS}, config)
    else:
        m = Models.from_testdata(spark, args.sf_dir, config)
    if args.command in ("run", "report", "snapshot") and not args.warehouse:
        ap.error(f"--warehouse is required for {args.command}")
    if args.command == "report":
        read_report(spark, args.warehouse, args.report).show(100, truncate=False)
        return 0
    if args.command == "run":
        paths, rules = materialize(m, args.warehouse, True) if args.measure else (materialize(m, args.warehouse), None)
        for name, path in paths.items():
            print(f"{name}\t{path}")
        return _report(rules) if rules is not None else 0
    if args.command == "snapshot":
        from fareflow.plans.history import snapshot
        for name, path in snapshot(m, args.warehouse).items():
            print(f"{name}\t{path}")
        return 0
    if args.command == "test":
        return _report(quality_checks.dq_summary(m))
    rows = quality_checks.dq_freshness(m).collect()
    for r in rows:
        print(f"{r['status']:14} {r['table']:26} max={r['max_loaded_at']} age_min={r['age_minutes']}")
    return 1 if any(r["status"] == "error" for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
