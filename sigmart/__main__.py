"""Command line: ``python -m sigmart ingest|build|check``, for spark-submit or a local run."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from sigmart.plans.build import build, check
from sigmart.plans.ingest import ingest
from sigmart.schemas import SIGNAL_TYPES
from sigmart.session import prepare


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sigmart")
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("ingest", help="validate JSON lines into envelopes, raw tables and dead letters")
    for kind in SIGNAL_TYPES:
        load.add_argument(f"--{kind.replace('_', '-')}", dest=kind, metavar="PATH", help=f"{kind} records")
    load.add_argument("--source", help="origin stamped on every envelope")
    load.add_argument("--out", required=True, help="output folder")

    make = commands.add_parser("build", help="build or refresh the fact and its dimensions")
    make.add_argument("--raw", required=True)
    make.add_argument("--marts", required=True)
    make.add_argument("--full-refresh", action="store_true")

    test = commands.add_parser("check", help="run the quality checks over the marts")
    test.add_argument("--raw", required=True)
    test.add_argument("--marts", required=True)
    test.add_argument("--as-of", required=True, help="UTC time freshness is judged at")
    test.add_argument("--alerts", help="folder failing checks are appended to")
    return parser.parse_args(argv)


def main(argv: list[str]) -> int:
    args = arguments(argv)
    spark = prepare(SparkSession.builder.appName(f"sigmart-{args.command}").getOrCreate())
    if args.command == "ingest":
        paths = {kind: getattr(args, kind) for kind in SIGNAL_TYPES if getattr(args, kind)}
        if not paths:
            print("nothing to ingest: give at least one record path", file=sys.stderr)
            return 1
        ingest(spark, paths, args.out, args.source).show()
        return 0
    if args.command == "build":
        build(spark, args.raw, args.marts, incremental=not args.full_refresh)
        return 0
    outcome = check(spark, args.raw, args.marts, args.as_of, args.alerts)
    outcome.show()
    return 0 if outcome.first()["success"] else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
