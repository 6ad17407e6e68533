"""Readers: typed CSV, whole lines, unions of periods, and stand-in views."""

from beatline.sources.csv import (
    parse_csv_lines, parse_incident_lines, read_by_header, read_csv_inferred, read_csv_text,
    read_geocodes_csv, read_incidents_csv, read_incomes_csv, read_stations_csv, type_incidents,
    typed_by_header,
)
from beatline.sources.periods import union_periods
from beatline.sources.text import drop_header, first_line, read_lines

__all__ = [
    "parse_csv_lines", "parse_incident_lines", "read_by_header", "read_csv_inferred", "read_csv_text",
    "read_geocodes_csv", "read_incidents_csv", "read_incomes_csv", "read_stations_csv", "type_incidents",
    "typed_by_header", "union_periods", "drop_header", "first_line", "read_lines",
]
