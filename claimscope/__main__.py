"""Command line: run the study reports over a folder of claims tables.

    spark-submit -m claimscope --tables s3://bucket/claims --format parquet \\
        --out s3://bucket/reports --start 2023-01-01 --end 2023-12-31

The session comes from the launcher (master, executors, checkpoint folder);
nothing here overrides cluster settings.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from claimscope.params import Condition, Window
from claimscope.plans.reports import REPORTS, run_reports
from claimscope.session import ensure_checkpoint_dir
from claimscope.sources import load_tables


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="claimscope", description=__doc__.splitlines()[0])
    ap.add_argument("--tables", required=True, help="folder with one sub-folder or file per table")
    ap.add_argument("--format", default="parquet", help="input format: parquet, csv, orc, json")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--out-format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--start", default="2023-01-01")
    ap.add_argument("--end", default="2023-12-31")
    ap.add_argument("--asof", default=None, help="age as-of date (default: window end)")
    ap.add_argument("--dx-flag", default="is_diabetes_flag")
    ap.add_argument("--rx-flag", default="is_antidiabetic_flag")
    ap.add_argument("--reports", default=",".join(REPORTS), help="comma-separated report names")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("claimscope").getOrCreate()
    ensure_checkpoint_dir(spark)
    tables = load_tables(spark, args.tables, args.format)
    w = Window(args.start, args.end, args.asof)
    cond = Condition(args.dx_flag, args.rx_flag)
    for path in run_reports(tables, args.out, w, cond, args.out_format, args.reports.split(",")):
        print(path)


if __name__ == "__main__":
    main()
