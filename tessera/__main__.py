"""Command line: land files, build the models, run the data tests.

    python -m tessera ingest  LANDING LAKE [--run-id ID]
    python -m tessera build   LAKE WAREHOUSE [--full-refresh] [--no-fail] [--grain month]
    python -m tessera profile LAKE

``spark-submit`` supplies the session on a cluster; run locally, a local
session is created.  ``build`` prints the data-test summary and exits
non-zero when an error-severity test fails (unless ``--no-fail``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The active session, or the one ``spark-submit`` configured (its master
    and settings win); a local session only when run as plain Python."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from pyspark import SparkConf
    if SparkConf().contains("spark.master"):
        return SparkSession.builder.getOrCreate()
    from tessera.session import local_session
    return local_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("ingest", help="land delivered CSV/TXT files into raw tables")
    p.add_argument("landing")
    p.add_argument("lake")
    p.add_argument("--run-id", default=None,
                   help="names this load; a retry with the same id replaces its rows")
    p = sub.add_parser("build", help="build bronze, silver, gold and marts, then test")
    p.add_argument("lake")
    p.add_argument("warehouse")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--no-fail", action="store_true", help="report error-severity tests, do not stop")
    p.add_argument("--select", default=None,
                   help="comma-separated models to build, with everything downstream of them")
    p.add_argument("--grain", choices=("year", "month"), default="year",
                   help="partition grain of the order tables")
    p = sub.add_parser("profile", help="check the raw tables against their contracts")
    p.add_argument("lake")
    args = ap.parse_args(argv)

    from tessera.contracts import CONTRACTS
    from tessera.sources import csv_ingest as ci
    spark = _session()
    if args.cmd == "ingest":
        out = ci.ingest(spark, args.landing, args.lake, run_id=args.run_id)
        print(json.dumps({"run_id": out["run_id"]}))
        for e in out["manifest"]:
            print(json.dumps({"file": e.path, "table": e.table, "accepted": e.accepted,
                              "reason": e.reason}))
        return 0
    raw = ci.raw_from_lake(spark, args.lake)
    if args.cmd == "profile":
        from tessera.operators.profile import profile
        for name, df in raw.items():
            for r in profile(df, CONTRACTS[name]).collect():
                print(json.dumps(r.asDict()))
        return 0
    from tessera.operators.quality import DataQualityError
    from tessera.plans import pipeline
    try:
        out = pipeline.build(spark, raw, args.warehouse, full_refresh=args.full_refresh,
                             fail_on_error=not args.no_fail, grain=args.grain,
                             select=args.select.split(",") if args.select else None,
                             raw_versions=pipeline.lake_versions(spark, args.lake))
    except DataQualityError as ex:
        print(str(ex), file=sys.stderr)
        return 1
    for r in out["tests"]:
        print(json.dumps(r))
    return 0


if __name__ == "__main__":
    sys.exit(main())
