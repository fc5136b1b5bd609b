"""Runs one step of the daily plan, for ``spark-submit`` or ``python -m ledgerlake``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ledgerlake.plans import daily
from ledgerlake.session import configure
from ledgerlake.sources.lake import Lake, checked_day


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerlake", description=__doc__)
    parser.add_argument("step", choices=["load", "vault", "marts", "run", "reconcile", "check", "export"])
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument("--dt", required=True, type=checked_day, help="business day, yyyy-MM-dd")
    parser.add_argument("--format", default="orc", choices=["orc", "parquet"])
    parser.add_argument("--stage", help="root folder of the staged extracts (load, run)")
    parser.add_argument("--quarantine", help="folder for rows with bad cells (load, run)")
    parser.add_argument("--previous", type=checked_day, help="newest day before: its history is continued (vault, run), its row counts are compared (check)")
    parser.add_argument("--extended", action="store_true", help="fill the optional mart columns (marts, run)")
    parser.add_argument("--out", help="folder of the JSON results (export)")
    args = parser.parse_args(argv)
    if args.step in ("load", "run") and not args.stage:
        parser.error("--stage is needed")
    if args.step == "export" and not args.out:
        parser.error("--out is needed")
    return args


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments(argv)
    spark = configure(spark or SparkSession.builder.appName("ledgerlake").getOrCreate())
    lake = Lake(spark, args.lake, args.format)
    if args.step == "load":
        daily.load_day(lake, args.stage, args.dt, args.quarantine)
    elif args.step == "vault":
        daily.build_vault_day(lake, args.dt, args.previous)
    elif args.step == "marts":
        daily.build_marts_day(lake, args.dt, args.extended)
    elif args.step == "run":
        daily.run_day(lake, args.stage, args.dt, args.previous, args.extended, args.quarantine)
    elif args.step == "reconcile":
        daily.reconcile_day(lake, args.dt).show(100, truncate=False)
    elif args.step == "check":
        daily.check_day(lake, args.dt, args.previous).show(100, truncate=False)
    else:
        daily.export_dashboard(lake, args.dt, args.out)


if __name__ == "__main__":
    main()
