"""Declared schemas and the rename map from the public file headers.

Every CSV is read with an explicit ``StructType`` (no inference pass over a
multi-GB file) and every column gets a snake_case name, so no query has to
quote names with blanks such as ``"AREA "``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the public incident file layout (28 columns, in file order).
# The header text is what the city publishes; position matters for the
# line-oriented reader (time at 3, premises at 15).
INCIDENT_HEADER = (
    "DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA ", "AREA NAME",
    "Rpt Dist No", "Part 1-2", "Crm Cd", "Crm Cd Desc", "Mocodes", "Vict Age",
    "Vict Sex", "Vict Descent", "Premis Cd", "Premis Desc", "Weapon Used Cd",
    "Weapon Desc", "Status", "Status Desc", "Crm Cd 1", "Crm Cd 2", "Crm Cd 3",
    "Crm Cd 4", "LOCATION", "Cross Street", "LAT", "LON",
)
TIME_FIELD_POS = 3
PREMISES_FIELD_POS = 15

_I, _L, _D, _S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

# (snake_case name, type) in file order; dates stay text until parsed by pattern.
INCIDENT_COLUMNS = (
    ("incident_id", _L), ("reported_text", _S), ("occurred_text", _S),
    ("time_hhmm", _I), ("area_id", _I), ("area_name", _S),
    ("report_district", _I), ("part", _I), ("crime_code", _I),
    ("crime_desc", _S), ("mocodes", _S), ("victim_age", _I),
    ("victim_sex", _S), ("category", _S), ("premises_code", _I),
    ("premises", _S), ("weapon_code", _I), ("weapon_desc", _S),
    ("status", _S), ("status_desc", _S), ("crime_code_1", _I),
    ("crime_code_2", _I), ("crime_code_3", _I), ("crime_code_4", _I),
    ("location", _S), ("cross_street", _S), ("lat", _D), ("lon", _D),
)

INCIDENT_CSV_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in INCIDENT_COLUMNS]
)
INCIDENT_RENAME = dict(zip(INCIDENT_HEADER, (n for n, _ in INCIDENT_COLUMNS)))

# Columns every composite query relies on after typing.
INCIDENT_CORE = (
    "incident_id", "occurred_at", "time_hhmm", "area_id", "area_name",
    "category", "weapon_code", "premises", "lat", "lon",
)

STATION_HEADER = ("X", "Y", "FID", "DIVISION", "LOCATION", "PREC")
STATION_SCHEMA = T.StructType([
    T.StructField("x", _D), T.StructField("y", _D), T.StructField("fid", _I),
    T.StructField("division", _S), T.StructField("location", _S),
    T.StructField("prec", _I),
])

INCOME_HEADER = ("Zip Code", "Community", "Estimated Median Income")
INCOME_SCHEMA = T.StructType([
    T.StructField("zip", _I), T.StructField("community", _S),
    T.StructField("income_text", _S),
])

GEOCODE_HEADER = ("LAT", "LON", "ZIPcode")
GEOCODE_SCHEMA = T.StructType([
    T.StructField("lat", _D), T.StructField("lon", _D),
    T.StructField("zip_text", _S),
])


def ddl(schema: T.StructType) -> str:
    """DDL string of a schema, as ``from_csv`` and ``readStream`` accept."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
