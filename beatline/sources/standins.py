"""Stand-in inputs derived from the benchmark tables.

The real incident, station, income and reverse-geocode files are not
available, so the queries run on views that Spark derives from whole driver
tables (``orders``, ``nation``, ``customer``) whenever a question runs. Where a
file is the point (CSV, text lines), the view is written as CSV files into a
new folder of the shared checkpoint folder, each time, and read back by the
package's own readers; no copy outlives the question that made it.

``beatline.plans.oracle`` states the same views as SQL of its own.

Coordinates are 1024ths of a degree, so they are exact doubles and safe as
equi-join keys. About one incident in nine lies at (0, 0), as unknown places
do in the real files; some have no date, no coordinates or no time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.functions.text import DESCENT_LABELS, parse_money
from beatline.functions.time import pattern_text
from beatline.schemas import (
    GEOCODE_HEADER, INCIDENT_COLUMNS, INCIDENT_CORE, INCIDENT_HEADER, INCOME_HEADER,
)
from beatline.session import ensure_checkpoint_dir
from beatline.sources.csv import (
    BYTE_ORDER_MARK, read_geocodes_csv, read_incidents_csv, read_incomes_csv, read_stations_csv,
)
from beatline.sources.text import read_lines

# Year of the category-by-area question (the driver's dates run 1995-2001).
STANDIN_YEAR = 1997
# Years from which income estimates hold.
ESTIMATE_YEARS = (1995, 1997, 1999, 2001)
# Second-period header: the later file names the area column without the blank.
SECOND_HEADER_NAMES = tuple(h.strip() for h in INCIDENT_HEADER)
SECOND_HEADER = ",".join(SECOND_HEADER_NAMES)
FIRST_HEADER = ",".join(INCIDENT_HEADER)
# The two incident files split at this date (like 2010-2019 and 2020-present).
PERIOD_CUT = "2000-01-01 00:00:00"
# Victim codes of the fixture: the known ones and one that no label has.
VICTIM_CODES = "".join(DESCENT_LABELS) + "Q"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _grid(idx: Column, base: float) -> Column:
    return F.lit(base) + idx.cast("double") / 1024.0


def _place(c: Column) -> tuple[Column, Column]:
    """Grid indices of a customer's home: one place for each customer."""
    return c * 37 % 4096, (c * 91 + F.floor(c / 4096)) % 4096


# --- the views, computed from the driver tables ------------------------------------

def build_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per order: the order's day with a time of day, at the customer's place; the
    rest is a deterministic function of the keys (with NULLs, gaps and odd values)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    hour, minute = k * 7 % 24, F.floor(k / 24) % 60
    li, lo = _place(c)
    area = (c % 27 + 1).cast("int")
    at = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hour.cast("int"), minute.cast("int"))
    dated = k % 97 != 5
    return _table(spark, sf_dir, "orders").select(
        k.alias("incident_id"),
        F.when(dated, at).alias("occurred_at"),
        F.when(dated, at + F.make_dt_interval(F.lit(1), F.lit(6))).alias("reported_at"),
        F.when(k % 89 != 3, (hour * 100 + minute).cast("int")).alias("time_hhmm"),
        area.alias("area_id"),
        F.concat(F.lit("Area "), area.cast("string")).alias("area_name"),
        F.when(k % 13 != 0, (k * 11 % 90 + 10).cast("int")).alias("victim_age"),
        F.when(k % 17 != 0, F.substring(F.lit(VICTIM_CODES), (k % len(VICTIM_CODES) + 1).cast("int"), 1))
        .alias("category"),
        F.when(k % 3 != 0, (k % 450 + 100).cast("int")).alias("weapon_code"),
        F.when(k % 4 == 0, "STREET").when(k % 4 == 1, "PARKING LOT")
        .when(k % 4 == 2, "STREET, SIDE").alias("premises"),
        F.when(k % 9 == 0, 0.0).when(k % 101 != 0, _grid(li, 33.5)).alias("lat"),
        F.when(k % 9 == 0, 0.0).otherwise(_grid(lo, -118.75)).alias("lon"),
        F.when(k % 5 == 0, 'THEFT, "PETTY"').otherwise("THEFT").alias("crime_desc"),
    )


def build_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 stations, one per nation; areas 26 and 27 have none."""
    n = F.col("n_nationkey")
    return _table(spark, sf_dir, "nation").select(
        _grid(n * 163 % 4096, -118.75).alias("x"),
        _grid(n * 211 % 4096, 33.5).alias("y"),
        (n + 1).cast("int").alias("fid"),
        F.concat(F.lit("AREA "), (n + 1).cast("string")).alias("division"),
        F.col("n_name").alias("location"),
        (n + 1).cast("int").alias("prec"),
    )


def build_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A post per supplier, so their number grows with the scale; some share a position, some have none."""
    k = F.col("s_suppkey")
    at = F.when(k % 10 == 3, k - 3).otherwise(k)
    return _table(spark, sf_dir, "supplier").select(
        _grid(at * 1009 % 4096, -118.75).alias("x"),
        F.when(k % 41 != 7, _grid(at * 613 % 4096, 33.5)).alias("y"),
        k.alias("fid"), F.concat(F.lit("Post "), k.cast("string")).alias("post"))


def build_next_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incidents as a later release has them. Of those before 1999 or without a date some are gone, some have lost
    their age, some of 1997 were moved by 400 days, and some are there again under a new number."""
    k, early = F.col("incident_id"), F.coalesce(F.year("occurred_at") < 1999, F.lit(True))
    inc = build_incidents(spark, sf_dir)
    moved = (F.year("occurred_at") == 1997) & (k % 211 == 4)
    kept = inc.where(~(early & (k % 83 == 2))).withColumns({
        "occurred_at": F.when(moved, F.col("occurred_at") + F.make_dt_interval(F.lit(400))).otherwise(F.col("occurred_at")),
        "victim_age": F.when(~(early & (k % 61 == 5)), F.col("victim_age"))})
    return kept.unionByName(inc.where(early & (k % 131 == 0)).withColumn("incident_id", -k - 1))


def build_incomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ZIP, 25 customers each, money as text (``$12,345``), ``---`` for some ZIPs
    without an estimate."""
    z = F.floor(F.col("c_custkey") / 25)
    g = _table(spark, sf_dir, "customer").groupBy(z.alias("z")).agg(F.sum(F.floor("c_acctbal")).alias("amount"))
    zip_ = (F.col("z") + 90000).cast("int")
    return g.select(
        zip_.alias("zip"),
        F.concat(F.lit('The "Old" Town, '), F.col("z").cast("string")).alias("community"),
        F.when(zip_ % 29 == 7, "---")
        .otherwise(F.concat(F.lit("$"), F.format_number("amount", 0))).alias("income_text"),
    )


def build_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income estimates by ZIP from the first day of every second year on, as the income files of several
    years give them; some ZIPs miss some years, and some have none."""
    zip_ = F.col("zip")
    year = F.explode(F.array(*[F.lit(y) for y in ESTIMATE_YEARS])).alias("year")
    return build_incomes(spark, sf_dir).select("zip", parse_money("income_text").alias("base"), year).where(
        ((zip_ + F.col("year")) % 7 != 3) & (zip_ % 11 != 4)).select(
        "zip", F.make_date("year", F.lit(1), F.lit(1)).alias("since"),
        (F.col("base") + (F.col("year") - 1995) * 100).alias("income"))


def build_watches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods in which an area is watched, one per supplier: up to 130 days long, some empty, some without
    an end, some of an area that has no incidents."""
    k = F.col("s_suppkey")
    start = F.date_add(F.lit("1995-01-01").cast("date"), ((F.floor(k / 28) * 45 + k % 28 * 80) % 2400).cast("int"))
    return _table(spark, sf_dir, "supplier").select(
        k.alias("watch_id"), (k % 28 + 1).cast("int").alias("area_id"), start.cast("timestamp_ntz").alias("start_at"),
        F.when(k % 13 != 6, F.date_add(start, (k * 17 % 131).cast("int")).cast("timestamp_ntz")).alias("end_at"))


def build_geocodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinate → ZIP text, one point per customer, some of them at (0, 0), de-duplicated.

    ZIP text is a single code, a ``code,99999`` list, or ``N/A``.
    """
    c = F.col("c_custkey")
    li, lo = _place(c)
    zip_ = (F.floor(c / 25) + 90000).cast("string")
    nowhere = c % 1000 == 0
    return _table(spark, sf_dir, "customer").select(
        F.when(nowhere, 0.0).otherwise(_grid(li, 33.5)).alias("lat"),
        F.when(nowhere, 0.0).otherwise(_grid(lo, -118.75)).alias("lon"),
        F.when(nowhere | (li % 64 == 5), "N/A").when(c % 2 == 0, F.concat(zip_, F.lit(",99999")))
        .otherwise(zip_).alias("zip_text"),
    ).distinct()


def incident_file_frame(inc: DataFrame, header: Sequence[str] = INCIDENT_HEADER) -> DataFrame:
    """Incidents in the public 28-column file layout, named by ``header``;
    dates as ``MM/dd/yyyy hh:mm:ss a`` text, unknown columns empty."""
    given = {"reported_text": pattern_text("reported_at"), "occurred_text": pattern_text("occurred_at")}
    cols = []
    for (name, dtype), head in zip(INCIDENT_COLUMNS, header):
        c = given.get(name, F.col(name) if name in inc.columns else F.lit(None).cast(dtype))
        cols.append(c.alias(head))
    return inc.select(*cols)


# --- the views as files ---------------------------------------------------------------

_CSV_WRITE = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false"}


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder that nothing uses yet."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/beatline-inputs/{name}-{uuid.uuid4().hex}"


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Incidents as they arrive: three deliveries in the order of time, some rows twice in one,
    and some of the first period only with the last."""
    inc = build_incidents(spark, sf_dir).select("incident_id", "occurred_at", "area_id")
    year, k = F.year("occurred_at"), F.col("incident_id")
    twice = inc.unionByName(inc.where(k % 50 == 0))
    late = (year < 1997) & (k % 97 == 1)
    return [twice.where((year < 1997) & ~late), twice.where((year >= 1997) & (year < 1999)), twice.where((year >= 1999) | late)]


def _write_csv(df: DataFrame, name: str) -> str:
    """Writes ``df`` as CSV files, each with a header, in a new shared folder."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**_CSV_WRITE).csv(path)
    return path


def incident_csv_paths(spark: SparkSession, sf_dir: str) -> list[str]:
    """The incident CSV files of both periods (each file starts with a header; the second
    period names the area column without the trailing blank, and holds the rows without a date)."""
    cut = F.lit(PERIOD_CUT).cast("timestamp_ntz")
    inc = build_incidents(spark, sf_dir)
    early = F.coalesce(F.col("occurred_at") < cut, F.lit(False))
    return [_write_csv(incident_file_frame(inc.filter(early), INCIDENT_HEADER), "incidents-1"),
            _write_csv(incident_file_frame(inc.filter(~early), SECOND_HEADER_NAMES), "incidents-2")]


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed incidents, derived from all orders."""
    return build_incidents(spark, sf_dir)


def incidents_csv(spark: SparkSession, sf_dir: str, bad_fields: str | None = None) -> DataFrame:
    """Typed incidents read back from both periods' CSV files."""
    return read_incidents_csv(spark, incident_csv_paths(spark, sf_dir), bad_fields)


def incident_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incident CSV files of both periods as whole text lines (headers included)."""
    return read_lines(spark, incident_csv_paths(spark, sf_dir))


def stations_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations read from a CSV file whose header starts with a byte order mark and has the
    columns in another order than the package's."""
    st = build_stations(spark, sf_dir).select(
        F.col("fid").alias(BYTE_ORDER_MARK + "FID"), F.col("prec").alias("PREC"), F.col("x").alias("X"),
        F.col("y").alias("Y"), F.col("division").alias("DIVISION"), F.col("location").alias("LOCATION "))
    return read_stations_csv(spark, _write_csv(st, "stations"))


def incomes_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incomes by ZIP read from a CSV file (quoted fields with commas and quotes, money text)."""
    return read_incomes_csv(spark, _write_csv(build_incomes(spark, sf_dir).toDF(*INCOME_HEADER), "incomes"))


def geocodes_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinate → ZIP text read from a CSV file (``LAT,LON,ZIPcode``)."""
    return read_geocodes_csv(spark, _write_csv(build_geocodes(spark, sf_dir).toDF(*GEOCODE_HEADER), "geocodes"))


def core(df: DataFrame) -> DataFrame:
    return df.select(*INCIDENT_CORE)
