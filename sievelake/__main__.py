"""Command line: `python -m sievelake series …` and `python -m sievelake single …`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sievelake.batch import Batch, Lake, under
from sievelake.operators.ledger import COUNTS
from sievelake.plans.one_pass import run_all
from sievelake.plans.series import Site, run_series, run_single
from sievelake.session import tune
from sievelake.sinks import catalog


def _period(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    if not 1 <= int(month) <= 12:
        raise argparse.ArgumentTypeError(f"no such month: {text}")
    return int(year), int(month)


def months(first: tuple[int, int], last: tuple[int, int]) -> list[tuple[int, int]]:
    start, end = (year * 12 + month - 1 for year, month in (first, last))
    return [(number // 12, number % 12 + 1) for number in range(start, end + 1)]


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--dataset", default="yellow_taxi")
    shared.add_argument("--prefix", default="yellow_tripdata", help="start of source file names")
    shared.add_argument("--work", default="", help="folder or URI that holds data/raw; default: current folder")
    shared.add_argument("--cast", action="store_true", help="cast columns to the table's types")
    commands = argparse.ArgumentParser(prog="sievelake", description=__doc__)
    kinds = commands.add_subparsers(dest="command", required=True)
    series = kinds.add_parser("series", parents=[shared], help="process, publish, register, reconcile")
    series.add_argument("--first", type=_period, required=True, metavar="YYYY-MM")
    series.add_argument("--last", type=_period, required=True, metavar="YYYY-MM")
    series.add_argument("--lake", help="root of the published layout; without it nothing is published")
    series.add_argument("--table", help="curated table; without it nothing is registered")
    series.add_argument("--no-reconcile", action="store_true")
    series.add_argument("--parallel", type=int, default=1, help="small batches that share the cluster")
    series.add_argument("--one-pass", action="store_true", help="take each step for all batches at once; needs --lake")
    series.add_argument("--rehash", action="store_true", help="hash all source files, whatever the stored manifest says")
    series.add_argument("--versioned", action="store_true", help="write partitions beside those that are read; needs --one-pass and --table")
    single = kinds.add_parser("single", parents=[shared], help="process one batch, without publication")
    single.add_argument("--period", type=_period, required=True, metavar="YYYY-MM")
    return commands


def _report(record: dict) -> None:
    counts = ", ".join(f"{name} {record[name]:,}" for name in COUNTS if name in record)
    steps = f"{record['processing_status']}, {record['reconciliation_status']}"
    print(f"{record['batch_id']}: {steps}{': ' + counts if counts else ''}")


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = tune(SparkSession.builder.appName("sievelake").getOrCreate())
    ledger = under(options.work, "data/metrics/pipeline_runs")
    try:
        if options.command == "single":
            batch = Batch(options.dataset, options.prefix, *options.period)
            record = run_single(spark, batch, Site(ledger, options.work, cast=options.cast))
            print(f"{batch.batch_id}: {'SKIPPED' if record is None else record['status']}")
            return
        lake = Lake(options.lake, options.versioned) if options.lake else None
        if lake and options.table:
            catalog.create_table(spark, options.table, lake.curated_root(options.dataset))
        site = Site(ledger, options.work, lake, options.table, not options.no_reconcile, cast=options.cast, rehash=options.rehash)
        batches = [Batch(options.dataset, options.prefix, *m) for m in months(options.first, options.last)]
        run = run_all(spark, batches, site) if options.one_pass else run_series(spark, batches, site, options.parallel)
        for record in run:
            _report(record)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
