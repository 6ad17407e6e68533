"""Filters, grouped counts, ranks and top/bottom-k as DataFrame → DataFrame steps.

Every aggregate here is algebraic (count, sum, avg), so Spark runs it as a
partial aggregate before the shuffle: a hot key costs one partial row per
task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.functions._util import as_col
from beatline.functions.time import year_range


# --- filters ------------------------------------------------------------------

def not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else (cond & F.col(c).isNotNull())
    return df.filter(cond)


# Partition column written by ``sources.csv.write_incidents_parquet``.
YEAR_PARTITION = "occurred_year"


def in_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows whose ``ts`` falls in ``year``: a range on ``ts`` (pushed to the
    Parquet scan) plus, on a table partitioned by ``occurred_year``, an
    equality on that column (whole other years' folders are skipped)."""
    out = df.filter(year_range(ts, year))
    if ts == "occurred_at" and YEAR_PARTITION in df.columns:
        out = out.filter(F.col(YEAR_PARTITION) == year)
    return out


def code_between(df: DataFrame, col: str, lo: int, hi: int) -> DataFrame:
    """Inclusive range filter (e.g. firearm weapon codes 100..199)."""
    return df.filter(F.col(col).between(lo, hi))


def containing(df: DataFrame, col: str, text: str) -> DataFrame:
    """Rows whose ``col`` contains ``text`` (SQL ``LIKE '%text%'``)."""
    return df.filter(F.col(col).contains(text))


# --- aggregates -----------------------------------------------------------------

def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "crime_count") -> DataFrame:
    """Row count per key (``groupBy(...).count()`` with a chosen name)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Whole-table row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def mean_and_count(df: DataFrame, keys: Sequence[str | Column], value: str, counted: str,
                   mean_name: str = "mean", count_name: str = "count") -> DataFrame:
    """Per key: mean of ``value`` (NULLs skipped) and non-NULL count of ``counted``."""
    return df.groupBy(*keys).agg(F.avg(value).alias(mean_name), F.count(counted).alias(count_name))


def mean_of_counted(df: DataFrame, keys: Sequence[str | Column], value: str, weight: str, counted: str,
                    mean_name: str = "mean", count_name: str = "count") -> DataFrame:
    """The same over rows that each stand for ``weight`` rows with the same value, of which
    ``counted`` are to be counted."""
    has = F.when(F.col(value).isNotNull(), F.col(weight))
    mean = F.try_divide(F.sum(F.col(value).cast("double") * F.col(weight)), F.sum(has))
    return df.groupBy(*keys).agg(mean.alias(mean_name), F.sum(counted).alias(count_name))


# --- ranks, sorts, limits -----------------------------------------------------------

def rank_within(df: DataFrame, partition: Sequence[str], order_desc: str, name: str = "rank",
                max_rank: int | None = None) -> DataFrame:
    """``rank()`` over ``partition`` by ``order_desc`` descending; ties share a
    rank, so a partition can keep more than ``max_rank`` rows."""
    w = Window.partitionBy(*partition).orderBy(F.col(order_desc).desc())
    out = df.withColumn(name, F.rank().over(w))
    return out if max_rank is None else out.filter(F.col(name) <= max_rank)


def top_k(df: DataFrame, order: str | Column, k: int, *, descending: bool = True,
          tie_break: Sequence[str] = (), drop_nulls: bool = False) -> DataFrame:
    """First ``k`` rows by ``order`` (ties broken by ``tie_break`` ascending).

    Spark plans this as a per-partition top-k plus one merge of
    ``k × partitions`` rows. NULL ``order`` values sort as in Spark (first
    when ascending, last when descending); ``drop_nulls`` leaves them out.
    """
    o = as_col(order)
    src = df.filter(o.isNotNull()) if drop_nulls else df
    key = o.desc() if descending else o.asc()
    return src.orderBy(key, *[F.col(t).asc() for t in tie_break]).limit(k)


def top_and_bottom(df: DataFrame, order: str, k: int, keep: Sequence[str],
                   tie_break: Sequence[str] = (), drop_nulls: bool = False) -> DataFrame:
    """Bag union of the ``k`` highest and ``k`` lowest rows (they may overlap)."""
    top = top_k(df, order, k, descending=True, tie_break=tie_break, drop_nulls=drop_nulls)
    bottom = top_k(df, order, k, descending=False, tie_break=tie_break, drop_nulls=drop_nulls)
    return top.select(*keep).union(bottom.select(*keep))


def sort_by_count(df: DataFrame, count: str, *ties: str) -> DataFrame:
    """Descending by ``count``, then ascending by ``ties`` (a total order)."""
    return df.orderBy(F.col(count).desc(), *[F.col(t).asc_nulls_first() for t in ties])
