"""The four loads as one spark-submit application.

    spark-submit --py-files feedloom.zip feedloom/jobs.py stops \\
        --landed s3a://lake/landed/stops --fallback s3a://lake/snapshots/stops \\
        --url jdbc:postgresql://db/transit

A table goes to JDBC (--url, with DB_USER and DB_PASSWORD set) or to files (--target).
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import month_key, request_key
from feedloom.operators import preview, project_documents, require_rows, row_counter
from feedloom.plans.feeds import STOPS, arrivals, incidents, passenger_volume, stops
from feedloom.sinks import append_once, append_table, jdbc_options, month_replace, replace_table, versions
from feedloom.sources import LANDED, RUNS, list_archives, read_archives, read_documents, read_landed
from feedloom.streaming import load_paged
from feedloom.workspace import clear

# The tables of the four loads.
TABLES = {
    "arrivals": "bus_arrivals",
    "stops": "bus_stops",
    "incidents": "traffic_incidents",
    "volume": "passenger_volume",
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    loads = top.add_subparsers(dest="load", required=True)
    for name, table in TABLES.items():
        load = loads.add_parser(name)
        source = load.add_mutually_exclusive_group(required=True)
        source.add_argument("--landed", help="landed responses (parquet)")
        source.add_argument("--documents", help="JSON document files, one response each")
        sink = load.add_mutually_exclusive_group(required=True)
        sink.add_argument("--url", help="JDBC url")
        sink.add_argument("--target", help="folder of a parquet table")
        load.add_argument("--table", default=table)
        load.add_argument("--connections", type=int, default=16, help="JDBC writers at a time")
        load.add_argument("--preview", type=int, default=0, metavar="N", help="print N rows first")
        if name in ("arrivals", "incidents"):
            load.add_argument("--on-failure", choices=("empty", "raise"), default="raise")
        if name in ("stops", "incidents"):
            load.add_argument("--lenient", action="store_true", help="mistyped numbers become NULL")
        if name == "stops":
            load.add_argument("--classified", action="store_true", help="the landed responses have an outcome")
            load.add_argument("--runs", action="store_true", help="the landed responses number runs and attempts")
            load.add_argument("--fallback", help="JSON snapshot files, named after their feeds")
            load.add_argument("--state", help="folder of remembered outcomes: read what newly landed, publish a version")
        if name == "volume":
            load.add_argument("--once", metavar="ID", help="add to the loads in --target, once under this id")
            load.add_argument("--archives", required=True, help="zip files; a link ends in its file's name")
            load.add_argument("--open", action="store_true", help="tasks open the zip files by path, of any size")
            load.add_argument("--schema", help="DDL of the CSV columns, in header order; inferred without")
            load.add_argument("--request", default="%s", help="feed of a month's link document, e.g. 'volume?Date=%%s'")
            load.add_argument("--date", type=dt.date.fromisoformat, default=dt.date.today(), help="run date")
            load.add_argument("--by-month", action="store_true", help="replace the month in --target, not append")
    return top


def rows_of(spark: SparkSession, args: argparse.Namespace, seen: Observation) -> DataFrame:
    if args.landed:
        marks = {name: getattr(args, name, False) for name in ("classified", "runs")}
        landed = read_landed(spark, args.landed, **marks)
    else:
        landed = read_documents(spark, args.documents)
    if args.load == "arrivals":
        return arrivals(landed, args.on_failure, seen)
    if args.load == "incidents":
        return incidents(landed, args.on_failure, not args.lenient, seen)
    if args.load == "stops":
        if not args.fallback:
            return stops(require_rows(landed, "any feed"), strict=not args.lenient)
        return stops(landed, read_documents(spark, args.fallback), strict=not args.lenient)
    month = request_key(args.request, month_key(F.lit(args.date)))
    links = require_rows(landed.where(F.col("feed") == month), "the month")
    archives = (list_archives if args.open else read_archives)(spark, args.archives)
    nothing = "void" if args.once else "string"  # other loads may know the type
    rows = passenger_volume(links, archives, args.schema, by_name=True, feed="_link_feed", nothing=nothing)
    rows = rows.drop("_link_feed")
    return require_rows(rows, "the month")


def _run_paged(args: argparse.Namespace) -> int:
    """The stops load from what newly landed, as a version of the target; the rows of the version it published."""
    spark = SparkSession.builder.appName(args.table).getOrCreate()
    schema = ", ".join([LANDED, *[RUNS] * args.runs, *["outcome string, reason string"] * args.classified])
    fallback = read_documents(spark, args.fallback) if args.fallback else None
    policy = "fallback" if args.fallback else "raise"

    def rows(pages: DataFrame) -> DataFrame:
        return project_documents(pages, STOPS, on_failure="raise", strict=not args.lenient)

    loaded = load_paged(spark, args.landed, args.target, args.state, rows, schema, policy, fallback)
    print(f"{loaded.new_rows} responses landed, {len(loaded.files)} files read, version {loaded.version or 'unchanged'}")
    clear(spark)
    if loaded.version is None:
        return 0
    return versions(spark, args.target).where(F.col("number") == loaded.version).first()["n_rows"]


def run(argv: Sequence[str] | None = None, env: Mapping[str, str] = os.environ) -> int:
    """Run one load and return the number of rows written."""
    arguments = parser()
    args = arguments.parse_args(argv)
    if args.load == "volume" and args.by_month and args.url:
        arguments.error("--by-month needs --target")
    if args.load == "volume" and args.once and (args.url or args.by_month):
        arguments.error("--once needs --target, and not --by-month")
    if args.load == "stops" and args.state:
        if not (args.landed and args.target):
            arguments.error("--state needs --landed and --target")
        return _run_paged(args)
    # Before anything is read: a run that cannot write should not start.
    options = jdbc_options(args.url, args.table, env) if args.url else {"path": args.target}
    fmt, connections = ("jdbc", args.connections) if args.url else ("parquet", None)
    spark = SparkSession.builder.appName(args.table).getOrCreate()
    failures = Observation()
    rows = rows_of(spark, args, failures)
    if args.preview:
        preview(rows, args.preview).show(args.preview, truncate=False)
    counted, seen = row_counter(rows)
    if args.load == "volume" and args.once:
        if not append_once(counted, args.target, args.once):
            return 0
    elif args.load == "volume" and args.by_month:
        month_replace(counted.withColumn("ym", month_key(F.lit(args.date))), args.target)
    elif args.load == "volume":
        append_table(counted, options, fmt, connections)
    else:
        replace_table(counted, options, fmt, connections)
    if args.load in ("arrivals", "incidents"):
        failed = {why: n for why, n in failures.get.items() if n and why != "responses"}
        print(f"{failures.get['responses']} responses, failed: {failed or 0}")
    clear(spark)
    return seen.get["rows"]


if __name__ == "__main__":
    print(f"{run()} rows written")
