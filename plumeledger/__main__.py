"""``python -m plumeledger load|analyse``, or the same through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.analysis import reports, run_analysis
from .sources.ingest import KINDS, load


def main() -> None:
    parser = argparse.ArgumentParser(prog="plumeledger")
    commands = parser.add_subparsers(dest="command", required=True)
    loader = commands.add_parser("load", help="load CSV files into the tables")
    loader.add_argument("csv_root", help="folder with <sector>/<file>.csv")
    loader.add_argument("--kinds", default="all", help=f"comma list of {', '.join(KINDS)}, or all")
    loader.add_argument("--filter", help="only files whose path contains this text")
    loader.add_argument(
        "--single-line", action="store_true", help="no cell has line breaks: split large files"
    )
    analysis = commands.add_parser("analyse", help="compute the rollup tables")
    for command in (loader, analysis):
        command.add_argument("--root", required=True, help="folder of the tables")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("plumeledger").getOrCreate()
    try:
        if args.command == "load":
            load(spark, args.csv_root, args.root, args.kinds, args.filter, False if args.single_line else None)
        else:
            run_analysis(spark, args.root)
            for title, report in reports(spark, args.root).items():
                print(f"=== {title} ===")
                report.show(report.count(), truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
