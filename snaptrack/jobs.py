"""Jobs for spark-submit: seed tables, build a history once, extend one every day.

    spark-submit --py-files snaptrack.zip snaptrack/jobs.py ingest \\
        --root s3a://gold --schema "id int, name string" now=/raw/now.csv base=/raw/base.csv
    spark-submit ... snaptrack/jobs.py history --key id --run-date 2024-06-01 \\
        --recent s3a://gold/now --history s3a://gold/base --out s3a://gold/history
    spark-submit ... snaptrack/jobs.py daily --key id --run-date 2024-06-01 \\
        --recent s3a://gold/now --table s3a://gold/history_table --base s3a://gold/base
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from snaptrack.meta import MetaColumns
from snaptrack.operators.history import MISSING, MODES, build_history
from snaptrack.operators.rows import ensure_history
from snaptrack.plans.replay import apply_snapshot
from snaptrack.session import session_conf
from snaptrack.sources.files import ingest, read_parquet, write_parquet
from snaptrack.sources.history_table import HistoryTable


def parser() -> argparse.ArgumentParser:
    jobs = argparse.ArgumentParser(prog="snaptrack")
    commands = jobs.add_subparsers(dest="job", required=True)

    seed = commands.add_parser("ingest", help="raw files to Parquet tables")
    seed.add_argument("tables", nargs="+", metavar="NAME=PATH")
    seed.add_argument("--root", required=True)
    seed.add_argument("--schema", help="DDL; inferred if absent")
    seed.add_argument("--format", choices=("csv", "json"), default="csv")

    diff = argparse.ArgumentParser(add_help=False)
    diff.add_argument("--recent", required=True, help="Parquet snapshot")
    diff.add_argument("--key", required=True, nargs="+")
    diff.add_argument("--run-date", default=str(dt.date.today()))
    diff.add_argument("--missing", choices=MISSING, default="keep")
    diff.add_argument("--meta", nargs=4, metavar=("ACTIVE", "CREATED", "EDITED", "CHANGES"))

    once = commands.add_parser("history", parents=[diff], help="one history from two tables")
    once.add_argument("--history", required=True, help="Parquet history, raw or with metadata")
    once.add_argument("--out", required=True)
    once.add_argument("--mode", choices=MODES, default="full")
    once.add_argument("--sort", action="store_true")

    daily = commands.add_parser("daily", parents=[diff], help="extend a stored history")
    daily.add_argument("--table", required=True, help="root of the stored history")
    daily.add_argument("--base", help="first history, needed while the table is empty")
    daily.add_argument("--base-date", help="date of --base, default the day before the run")
    daily.add_argument(
        "--free-superseded", type=int, metavar="N", help="free the active rows of all but N runs"
    )
    return jobs


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    if args.job == "ingest":
        tables = dict(item.split("=", 1) for item in args.tables)
        ingest(spark, tables, args.root, args.schema, args.format)
        return

    meta = MetaColumns(*args.meta) if args.meta else MetaColumns()
    recent = read_parquet(spark, args.recent)
    if args.job == "history":
        history = read_parquet(spark, args.history)
        result = build_history(
            recent, history, args.key, args.run_date, meta,
            mode=args.mode, missing=args.missing, sort=args.sort,
        )
        write_parquet(result, args.out)
        return

    table = HistoryTable(args.table, meta)
    if args.base and not table.runs(spark):
        day_before = dt.date.fromisoformat(args.run_date) - dt.timedelta(days=1)
        first_day = args.base_date or str(day_before)
        table.write(ensure_history(read_parquet(spark, args.base), first_day, meta), first_day)
    apply_snapshot(spark, table, args.run_date, recent, args.key, args.missing)
    if args.free_superseded is not None:
        table.drop_superseded(spark, args.free_superseded)


if __name__ == "__main__":
    run(SparkSession.builder.appName("snaptrack").config(map=session_conf()).getOrCreate())
