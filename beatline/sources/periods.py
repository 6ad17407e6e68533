"""The union of period tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_periods(*periods: DataFrame, by_name: bool = True) -> DataFrame:
    """Bag union of period tables (e.g. 2010-2019 and 2020-present).

    ``by_name`` matches columns by name after the snake_case rename; the
    positional form (``by_name=False``) keeps the left side's names.
    """
    if not periods:
        raise ValueError("need at least one period")
    op = (lambda a, b: a.unionByName(b)) if by_name else (lambda a, b: a.union(b))
    return reduce(op, periods)
