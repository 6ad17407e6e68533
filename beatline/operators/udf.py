"""The one user-function hook: add a column computed by a Python function.

Built-in column functions cover every query in this package; this hook is for
callers who need their own per-row logic. By default the function is run as a
pandas UDF (Arrow batches, one call per batch); ``vectorized=False`` gives a
plain row-at-a-time UDF for functions written on scalars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def with_udf(df: DataFrame, name: str, fn: Callable, return_type: DataType | str, *cols: str,
             vectorized: bool = True) -> DataFrame:
    """``df`` plus column ``name = fn(*cols)``.

    ``vectorized=True``: ``fn`` takes and returns ``pandas.Series``.
    ``vectorized=False``: ``fn`` takes and returns Python scalars.
    """
    wrapped = F.pandas_udf(fn, return_type) if vectorized else F.udf(fn, return_type)
    return df.withColumn(name, wrapped(*[F.col(c) for c in cols]))
