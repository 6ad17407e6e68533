"""Typed CSV sources (incidents, stations, incomes, geocodes).

All readers take any Hadoop path or list of paths (``hdfs://``, ``s3a://``,
local). Columns are found by the text of the file's header line, blanks and a
byte order mark around it removed, so files whose columns stand in another
order, or whose header differs in blanks (``AREA `` and ``AREA``), line up; a
file without a needed column fails. Quotes inside a quoted field are doubled.
A field that does not parse as its type becomes NULL and can be listed in a
column of bad fields.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.functions.time import parse_date, parse_timestamp
from beatline.schemas import (
    GEOCODE_HEADER, GEOCODE_SCHEMA, INCIDENT_CSV_SCHEMA, INCIDENT_HEADER, INCOME_HEADER,
    INCOME_SCHEMA, STATION_HEADER, STATION_SCHEMA, ddl,
)

Paths = str | Sequence[str]

# --- fixed values: how the public files quote (a quote in a field is doubled).
CSV_OPTIONS = {"mode": "PERMISSIVE", "escape": '"'}
BYTE_ORDER_MARK = "\ufeff"


def plain_header(text: str) -> str:
    """Header text without blanks and byte order mark around it."""
    return text.strip().strip(BYTE_ORDER_MARK).strip()


def read_csv_text(spark: SparkSession, path: str, **options) -> DataFrame:
    """One CSV file, or folder of files with one header, as text columns named by the header.
    Files of a folder whose header differs from the first one's fail the read."""
    reader = spark.read.options(header=True, inferSchema=False, enforceSchema=False, **CSV_OPTIONS, **options)
    raw = reader.csv(path)
    return raw.toDF(*map(plain_header, raw.columns))


def typed_by_header(raw: DataFrame, columns: Mapping[str, T.StructField], bad_fields: str | None = None,
                    where: str = "the file") -> DataFrame:
    """Columns of text ``raw``, picked by header, named and typed by ``columns`` (header → field).

    ``bad_fields`` names an extra array column with the names of the fields whose text isn't a
    value of their type."""
    missing = [h for h in columns if h not in raw.columns]
    if missing:
        raise ValueError(f"{where} has no column {', '.join(missing)}; it has {', '.join(raw.columns)}")

    def cast(head: str, field: T.StructField) -> Column:
        return F.col(f"`{head}`").try_cast(field.dataType)

    out = [cast(h, f).alias(f.name) for h, f in columns.items()]
    if bad_fields:
        out.append(F.array_compact(F.array(*[
            F.when(F.col(f"`{h}`").isNotNull() & cast(h, f).isNull(), f.name) for h, f in columns.items()])).alias(bad_fields))
    return raw.select(*out)


def read_by_header(spark: SparkSession, paths: Paths, header: Sequence[str], schema: T.StructType,
                   bad_fields: str | None = None, **options) -> DataFrame:
    """CSV files, each read by its own header line, as one table with the columns of ``schema``;
    ``header`` gives the header texts of its fields, in order."""
    columns = {plain_header(h): f for h, f in zip(header, schema.fields)}
    parts = [typed_by_header(read_csv_text(spark, p, **options), columns, bad_fields, p)
             for p in ([paths] if isinstance(paths, str) else paths)]
    return reduce(DataFrame.unionByName, parts)


def read_csv_inferred(spark: SparkSession, paths: Paths, **options) -> DataFrame:
    """CSV with inferred types, for a look at a new file: one more pass over all of it."""
    reader = spark.read.options(header=True, inferSchema=True, **CSV_OPTIONS, **options)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def type_incidents(raw: DataFrame) -> DataFrame:
    """Parse the date texts: ``occurred_at`` (timestamp_ntz), ``reported_on`` (date)."""
    return raw.withColumns({
        "occurred_at": parse_timestamp("occurred_text"),
        "reported_on": parse_date("reported_text"),
    })


def read_incidents_csv(spark: SparkSession, paths: Paths, bad_fields: str | None = None) -> DataFrame:
    """Incident files (one or several periods) → typed, snake_case DataFrame."""
    return type_incidents(read_by_header(spark, paths, INCIDENT_HEADER, INCIDENT_CSV_SCHEMA, bad_fields))


def parse_csv_lines(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """CSV text lines (no header) → typed rows by position, quoted as in the files
    (``from_csv``: bad fields → NULL)."""
    parsed = lines.select(F.from_csv(F.col(value), ddl(schema), CSV_OPTIONS).alias("r"))
    return parsed.select("r.*")


def parse_incident_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """CSV text lines (no header) → typed incidents."""
    return type_incidents(parse_csv_lines(lines, INCIDENT_CSV_SCHEMA, value))


def read_stations_csv(spark: SparkSession, path: Paths) -> DataFrame:
    """Station file with the columns X, Y, FID, DIVISION, LOCATION, PREC (a leading BOM is fine)."""
    return read_by_header(spark, path, STATION_HEADER, STATION_SCHEMA)


def read_incomes_csv(spark: SparkSession, path: Paths) -> DataFrame:
    """Income file: quoted fields with commas; money kept as text (``income_text``)."""
    return read_by_header(spark, path, INCOME_HEADER, INCOME_SCHEMA)


def read_geocodes_csv(spark: SparkSession, path: Paths) -> DataFrame:
    """Reverse-geocode file with the columns LAT, LON, ZIPcode (ZIPcode may be a comma list)."""
    return read_by_header(spark, path, GEOCODE_HEADER, GEOCODE_SCHEMA)


def write_incidents_parquet(incidents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store typed incidents as Parquet partitioned by ``occurred_year``, so
    later questions read only the columns they use and a year filter skips
    other years' folders.

    Rows are range-partitioned by date and, within a date, by the row's hash
    (never hashed by year, which would send a whole year to one task): each
    task writes one slice, sorted by date, so files are few and their min/max
    statistics stay narrow, and a hot day or the rows without a date spread
    over several tasks.
    """
    from beatline.operators.relational import YEAR_PARTITION
    (year_partitioned(incidents).write.mode(mode).partitionBy(YEAR_PARTITION).parquet(path))


def year_partitioned(incidents: DataFrame) -> DataFrame:
    """Incidents with ``occurred_year``, range-partitioned by date and row hash, sorted by date."""
    from beatline.operators.relational import YEAR_PARTITION
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in incidents.columns])
    return (incidents.withColumn(YEAR_PARTITION, F.year("occurred_at"))
            .repartitionByRange(F.col("occurred_at"), spread).sortWithinPartitions("occurred_at"))


def update_incidents_parquet(old: DataFrame, new: DataFrame, changes: DataFrame, path: str, key: str = "incident_id") -> list[int | None]:
    """Brings a table that :func:`write_incidents_parquet` stored from ``old`` up to ``new``: writes the years that
    a changed row was or is in, and leaves the files of all others as they are. Returns these years.

    ``changes`` is the change set of the two releases. A year that has lost all its rows loses its folder. The years come
    to the driver, of which a calendar has few; running it again after a failure gives the same table."""
    from beatline.operators.changes import touched_values
    from beatline.operators.relational import YEAR_PARTITION
    spark, year = new.sparkSession, F.year("occurred_at")
    touched = [r["part"] for r in touched_values(old, new, changes, [key], year).collect()]
    if not touched:
        return []
    known = [y for y in touched if y is not None]
    within = year.isin(known) if known else F.lit(False)
    rows = new.where((within | year.isNull()) if None in touched else within)
    left = {r[0] for r in rows.select(year).distinct().collect()}
    (year_partitioned(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(YEAR_PARTITION).parquet(path))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for y in set(touched) - left:
        folder = hadoop(f"{path}/{YEAR_PARTITION}={'__HIVE_DEFAULT_PARTITION__' if y is None else y}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return sorted(touched, key=lambda y: (y is None, y))
