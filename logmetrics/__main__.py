"""Run a job: ``python -m logmetrics levels|usage|daily|entries SOURCE TARGET``."""

import argparse

from pyspark.sql import SparkSession

from .plans import jobs
from .sources import LOG_FILES


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="logmetrics", description=__doc__)
    parser.add_argument("--master", help="cluster to connect to; default as configured")
    job = parser.add_subparsers(dest="job", required=True)

    def add(name: str, text: str, source: str) -> argparse.ArgumentParser:
        sub = job.add_parser(name, help=text)
        sub.add_argument("source", help=source)
        sub.add_argument("target", help="directory for the results")
        return sub

    for name, text in (("levels", "level distribution"), ("usage", "cluster usage"), ("entries", "parsed entries as parquet")):
        add(name, text, "root of the log tree").add_argument("--glob", default=LOG_FILES, help="names of log files")
    job.choices["entries"].add_argument("--anywhere", action="store_true", help="take time stamps inside a line, too")
    job.choices["levels"].add_argument("--sample", choices=["earliest", "hash", "none"], default="earliest")
    job.choices["usage"].add_argument("--resume", action="store_true", help="go on from the stored timeline")
    daily = add("daily", "daily trip measures", "parquet files: a path, a wildcard, or several with commas")
    daily.add_argument("--year", type=int, required=True)
    daily.add_argument("--months", help="numbers with commas; the source is then a table by yyyy and mm")
    daily.add_argument("--exact", action="store_true", help="exact quantile, at a second scan")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    builder = SparkSession.builder.appName(f"logmetrics-{args.job}").config("spark.sql.session.timeZone", "UTC")
    spark = (builder.master(args.master) if args.master else builder).getOrCreate()
    if args.job == "levels":
        sample = None if args.sample == "none" else args.sample
        jobs.level_distribution(spark, args.source, args.target, args.glob, sample)
    elif args.job == "usage":
        jobs.cluster_usage(spark, args.source, args.target, args.glob, args.resume)
    elif args.job == "entries":
        jobs.entry_table(spark, args.source, args.target, args.glob, anchored=not args.anywhere)
    else:
        months = [int(m) for m in args.months.split(",")] if args.months else None
        source = args.source if months else args.source.split(",")
        jobs.daily_report(spark, source, args.target, args.year, months, exact=args.exact).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
