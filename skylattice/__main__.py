"""Command line: ``python -m skylattice --root DIR JOB [--raw DIR] ...``.

Tables live in folders under ``--root`` or, with ``--jdbc FILE``, in a database: the JSON file
holds ``url``, ``properties`` (user, password, driver) and ``ranges`` as ``JdbcStore`` takes them.
"""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from skylattice.functions.periods import date_period
from skylattice.operators.health import all_stats, append_health
from skylattice.plans import jobs
from skylattice.schemas import TABLES
from skylattice.session import CO_LOCATED, build
from skylattice.sources.raw import read_raw
from skylattice.sources.tables import CatalogStore, FileStore, JdbcStore, seed_cities
from skylattice.storage import exists
from skylattice.streaming.observations import land_stream


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="skylattice", description=__doc__)
    place = parser.add_mutually_exclusive_group(required=True)
    place.add_argument("--root", help="folder of the tables")
    place.add_argument("--database", help="catalog database of bucketed tables")
    place.add_argument("--jdbc", help="JSON file describing the database")
    parser.add_argument("--on-conflict", default="error", choices=["append", "error", "skip", "replace"])
    parser.add_argument("--tz", default="UTC", help="zone of dates and hours")
    parser.add_argument("--master", help="Spark master, for a run outside spark-submit")
    job = parser.add_subparsers(dest="job", required=True)
    for name in ("hourly", "daily", "condition", "condition-backfill", "monthly", "weekly", "quality", "health", "increment"):
        sub = job.add_parser(name)
        if name == "increment":
            sub.add_argument("--lot", required=True, help="name of the observations in --raw, which hold this lot alone")
        else:
            sub.add_argument("--as-of", type=datetime.fromisoformat, required=True)
        if name in ("hourly", "condition", "condition-backfill", "quality", "increment"):
            _raw_arguments(sub)
        if name == "quality":
            sub.add_argument("--reports", required=True, help="folder of the reports")
        if name == "health":
            sub.add_argument("--raw-path", help="landed raw observations, reported as a table too")
    for name in ("hourly-backfill", "daily-backfill"):
        sub = job.add_parser(name)
        required = name == "daily-backfill"
        sub.add_argument("--start-date", type=date.fromisoformat, required=required)
        sub.add_argument("--end-date", type=date.fromisoformat, required=required)
        if not required:
            _raw_arguments(sub)
    job.add_parser("analyze", help="column statistics of the tables of --database")
    land = job.add_parser("land")
    land.add_argument("--incoming", required=True)
    land.add_argument("--raw", required=True, help="folder of raw observations")
    land.add_argument("--checkpoint", help="folder that says which files have landed; by default beside --raw")
    land.add_argument("--multiline", action="store_true", help="each file is one document")
    dims = job.add_parser("load-dims")
    dims.add_argument("--seed", required=True)
    dims.add_argument("--seed-format", default="json")
    return parser.parse_args(argv)


def _raw_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--raw", help="folder or table of raw observations")
    parser.add_argument("--raw-format", default="parquet", help="parquet, json or a connector name")
    parser.add_argument(
        "--raw-option", action="append", default=[], metavar="KEY=VALUE", help="reader option"
    )


def _store(spark: SparkSession, args: argparse.Namespace) -> FileStore | CatalogStore | JdbcStore:
    if args.database:
        return CatalogStore(spark, args.database)
    if args.root:
        return FileStore(spark, args.root)
    with open(args.jdbc) as f:
        return JdbcStore(spark, **json.load(f))


def _read_raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = dict(o.split("=", 1) for o in args.raw_option)
    return read_raw(spark, args.raw, args.raw_format, **options)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    if args.job == "health" and not args.root:
        raise SystemExit("health reads the stored files: it needs --root")
    if args.job == "daily-backfill":
        date_period(args.start_date, args.end_date)
    if args.job == "analyze" and not args.database:
        raise SystemExit("analyze is for catalog tables: it needs --database")
    spark = build("skylattice", args.master, **(CO_LOCATED if args.database else {}))
    store = _store(spark, args)
    mode = {"on_conflict": args.on_conflict, "tz": args.tz}
    raw = _read_raw(spark, args) if "raw" in args and args.job != "land" else None
    if args.job == "hourly":
        jobs.hourly_job(raw, store, args.as_of, **mode)
    elif args.job == "hourly-backfill":
        jobs.hourly_backfill(raw, store, args.start_date, args.end_date, **mode)
    elif args.job == "daily":
        jobs.daily_job(store, args.as_of, **mode)
    elif args.job == "daily-backfill":
        jobs.daily_backfill(store, args.start_date, args.end_date, **mode)
    elif args.job == "condition":
        jobs.condition_job(raw, store, args.as_of, **mode)
    elif args.job == "condition-backfill":
        jobs.condition_backfill(raw, store, args.as_of, **mode)
    elif args.job == "monthly":
        jobs.monthly_job(store, args.as_of, **mode)
    elif args.job == "weekly":
        jobs.weekly_job(store, args.as_of, **mode)
    elif args.job == "increment":
        if not args.root:
            raise SystemExit("increment keeps its sums in files: it needs --root")
        jobs.increment_job(raw, store, args.lot, args.tz)
    elif args.job == "analyze":
        jobs.analyze_job(store)
    elif args.job == "quality":
        jobs.quality_job(raw, store, args.reports, args.as_of)
    elif args.job == "land":
        checkpoint = args.checkpoint or f"{args.raw.rstrip('/')}-landed"
        land_stream(spark, args.incoming, args.raw, checkpoint, args.multiline).awaitTermination()
    elif args.job == "load-dims":
        jobs.load_dims(seed_cities(spark, args.seed, args.seed_format), store)
    elif args.job == "health":
        written = {n: store.path(n) for n in TABLES if exists(spark, store.path(n))}
        if args.raw_path:
            written["raw"] = args.raw_path
        append_health(all_stats(spark, written, TABLES), args.as_of, f"{args.root}/health")


if __name__ == "__main__":
    main()
