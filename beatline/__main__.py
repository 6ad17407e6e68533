"""Run one question on real input files, as a job for ``spark-submit``.

    spark-submit --py-files beatline.zip beatline/__main__.py top-months \\
        --incidents hdfs:///data/crime_2010_2019.csv hdfs:///data/crime_2020_now.csv

    python -m beatline nearest-division --incidents ... --stations ... --out hdfs:///results/nearest_division

The result is shown (``--show`` rows) or written as Parquet (``--out``).
``convert`` stores the incident CSV files once as Parquet partitioned by year;
later runs read it with ``--incidents-format parquet``.
Session settings (executors, memory, checkpoint folder) come from
``spark-submit``; nothing here sets them.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from beatline.plans import queries as Q
from beatline.sources import (
    first_line, read_geocodes_csv, read_incidents_csv, read_incomes_csv, read_lines,
    read_stations_csv,
)
from beatline.sources.csv import write_incidents_parquet
from beatline.sources.sinks import write_table
from beatline.operators import profile, row_count


def _build(args, spark: SparkSession) -> DataFrame:
    if args.incidents_format == "parquet":
        inc = lambda: spark.read.parquet(*args.incidents)
    else:
        inc = lambda: read_incidents_csv(spark, args.incidents)
    st = lambda: read_stations_csv(spark, args.stations)
    q = args.question
    if q == "top-months":
        return Q.top_months_by_count_sql(inc()) if args.sql else Q.top_months_by_count(inc())
    if q == "day-segments":
        return Q.day_segment_counts(inc())
    if q == "day-segments-lines":
        lines = read_lines(spark, args.incidents)
        header = args.header or first_line(spark, args.incidents)
        return Q.day_segment_counts_lines(lines, header)
    if q == "extreme-areas":
        return Q.category_counts_extreme_areas(
            inc(), read_geocodes_csv(spark, args.geocodes), read_incomes_csv(spark, args.incomes),
            args.year, strategy=args.strategy, drop_nulls=args.drop_null_incomes)
    if q == "yearly-area-distance":
        return Q.yearly_area_distance(inc(), st(), strategy=args.strategy)
    if q == "division-distance":
        return Q.division_distance_stats(inc(), st(), strategy=args.strategy)
    if q == "yearly-nearest":
        return Q.yearly_nearest_distance(inc(), st())
    if q == "nearest-division":
        return Q.nearest_division_stats(inc(), st())
    if q == "profile":
        return profile(inc())
    if q == "count":
        return row_count(inc())
    if q == "convert":
        if not args.out:
            raise SystemExit("convert needs --out")
        write_incidents_parquet(inc(), args.out)
        return spark.read.parquet(args.out)
    raise SystemExit(f"unknown question {q}")


QUESTIONS = ("top-months", "day-segments", "day-segments-lines", "extreme-areas",
             "yearly-area-distance", "division-distance", "yearly-nearest", "nearest-division",
             "profile", "count", "convert")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="beatline", description="Run one incident question.")
    p.add_argument("question", choices=QUESTIONS)
    p.add_argument("--incidents", nargs="+", required=True, help="incident files (all periods)")
    p.add_argument("--incidents-format", default="csv", choices=("csv", "parquet"),
                   help="parquet: a table written by the convert question")
    p.add_argument("--stations", help="station CSV")
    p.add_argument("--incomes", help="income-by-ZIP CSV")
    p.add_argument("--geocodes", help="coordinate-to-ZIP CSV")
    p.add_argument("--year", type=int, default=2015)
    p.add_argument("--strategy", default="auto", choices=("auto", "broadcast", "merge", "shuffle_hash"))
    p.add_argument("--sql", action="store_true", help="top-months as SQL text")
    p.add_argument("--header", help="header line to drop (default: first line of the first file)")
    p.add_argument("--drop-null-incomes", action="store_true",
                   help="areas without an income are not the poorest")
    p.add_argument("--out", help="write the result here as Parquet instead of showing it")
    p.add_argument("--show", type=int, help="rows to print (default: all)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"beatline-{args.question}").getOrCreate()
    df = _build(args, spark)
    if args.question == "convert":
        return df
    if args.out:
        write_table(df, args.out)
    else:
        df.show(df.count() if args.show is None else args.show, truncate=False)
    return df


if __name__ == "__main__":
    main(sys.argv[1:])
