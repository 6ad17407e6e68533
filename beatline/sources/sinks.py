"""Result sink: write a question's result as a table instead of printing it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), **options) -> None:
    """Write ``df`` to ``path`` (any Hadoop path) through the committer, so a
    failed job leaves no partial result behind a ``_SUCCESS`` marker."""
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
