"""Line-oriented source: whole text lines, split positionally on every comma."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text files → DataFrame ``value: string``, one row per line."""
    return spark.read.text(list(paths) if not isinstance(paths, str) else paths)


def first_line(spark: SparkSession, paths: str | Sequence[str]) -> str | None:
    """The first line of the first file that has one (one row to the driver, not the file)."""
    for path in [paths] if isinstance(paths, str) else paths:
        row = spark.read.text(path).limit(1).first()
        if row is not None:
            return row[0]
    return None


def drop_header(lines: DataFrame, header: str | None, value: str = "value") -> DataFrame:
    """Drop every line equal to ``header`` (a later file's different header stays); without a
    header, as of files that hold no line, nothing is dropped."""
    return lines if header is None else lines.filter(~F.col(value).eqNullSafe(F.lit(header)))
