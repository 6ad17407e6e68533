"""Joins by time: the latest state as of a moment, and periods that hold a moment or overlap.

All are equi-joins on the keys and a time bin of ``width`` days, with the exact condition beside
it, so Spark deals them out by key and bin and splits what is still too large; no window ever holds the
facts of a key. Bins only deal the work out: any width gives the same rows. A good one is about as wide as the
states of one key lie apart, or as the periods are long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN, LOW, HIGH = "__bin", "__low", "__high"


def day_bin(at: str | Column, width: int) -> Column:
    """The number of the bin of ``width`` days (since 1970) that the date or timestamp lies in."""
    at = F.col(at) if isinstance(at, str) else at
    return F.floor(F.unix_date(at.cast("date")) / width).cast("int")


def state_pieces(facts: DataFrame, states: DataFrame, on: Sequence[str], at: str, since: str, keep: Sequence[str],
                 width: int) -> DataFrame:
    """``on``, bin, low, high (null: open), ``since`` and ``keep``: for each bin that has facts of a key, the
    states that hold in it and from when to when. The first is carried in from the last bin before that has a state.

    Windows hold the states of one key in one bin, and one row for each bin of a key. Of several states with one
    moment the one with the highest kept values counts."""
    held = F.struct(F.col(since).alias("since"), *[F.col(k) for k in keep])
    known = states.where(F.col(since).isNotNull()).groupBy(*on, F.col(since)).agg(F.max(held).alias("state")).withColumn(
        BIN, day_bin(since, width))
    last = known.groupBy(*on, BIN).agg(F.max("state").alias("last"))
    asked = facts.where(F.col(at).isNotNull()).select(*on, day_bin(at, width).alias(BIN)).distinct().withColumn("asked", F.lit(True))
    bins = last.join(asked, [*on, BIN], "full")
    before = Window.partitionBy(*on).orderBy(BIN).rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.withColumn("state", F.last("last", ignorenulls=True).over(before)).where("asked AND state IS NOT NULL").select(
        *on, BIN, F.lit(None).cast(states.schema[since].dataType).alias(LOW), "state")
    inside = known.join(asked, [*on, BIN], "left_semi").select(*on, BIN, F.col(since).alias(LOW), "state")
    order = Window.partitionBy(*on, BIN).orderBy(F.asc_nulls_first(LOW))
    pieces = carried.unionByName(inside).withColumn(HIGH, F.lead(LOW).over(order))
    return pieces.select(*on, BIN, LOW, HIGH, F.col("state.since").alias(since), *[F.col(f"state.{k}").alias(k) for k in keep])


def as_of_join(facts: DataFrame, states: DataFrame, on: Sequence[str], at: str, since: str,
               keep: Sequence[str], width: int = 365) -> DataFrame:
    """``facts`` with ``since`` and ``keep`` of the latest state of the same key that is not after ``at``.

    Every fact is kept once; those without a key or time, or before the first state, get NULLs."""
    pieces = state_pieces(facts, states, on, at, since, keep, width)
    found = facts.withColumn(BIN, day_bin(at, width)).join(pieces.withColumnsRenamed({k: f"__{k}" for k in on}).withColumnRenamed(
        BIN, "__piece"), _same(on) & (F.col(BIN) == F.col("__piece"))
        & (F.col(LOW).isNull() | (F.col(at) >= F.col(LOW))) & (F.col(HIGH).isNull() | (F.col(at) < F.col(HIGH))), "left")
    return found.select(*[F.col(f"`{c}`") for c in facts.columns], since, *keep)


def _same(on: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in on:
        out = out & (F.col(k) == F.col(f"__{k}"))
    return out


def _in_bins(periods: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """A row for each bin that a period touches; empty and reversed periods, and those without an end, have none."""
    return periods.where(F.col(start) < F.col(end)).withColumn(BIN, F.explode(F.sequence(
        day_bin(start, width), day_bin(end, width))))


def in_periods(facts: DataFrame, periods: DataFrame, on: Sequence[str], at: str, start: str, end: str,
               width: int = 30, open_ended: bool = False) -> DataFrame:
    """Each fact with each period of its key that holds its time: ``start`` <= ``at`` < ``end``.

    A period is copied to the bins that it touches, a fact lies in one, so no pair comes twice. With ``open_ended``
    a period without an end goes on beyond the last fact, else it holds nothing."""
    if open_ended:
        last = facts.agg(F.max(at).cast("date")).scalar()
        periods = periods.withColumn(end, F.coalesce(end, F.date_add(F.greatest(last, F.col(start).cast("date")), 1).cast(
            periods.schema[end].dataType)))
    held = _in_bins(periods, start, end, width).withColumnsRenamed({**{k: f"__{k}" for k in on}, BIN: "__piece"})
    found = facts.withColumn(BIN, day_bin(at, width)).join(
        held, _same(on) & (F.col(BIN) == F.col("__piece")) & (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end)))
    return found.drop(BIN, "__piece", *[f"__{k}" for k in on])


def overlapping(left: DataFrame, right: DataFrame, on: Sequence[str], start: str, end: str, width: int = 30) -> DataFrame:
    """Pairs of a left and a right period of one key that share a moment; columns of the right side get ``_2``.

    Both sides are copied to the bins that they touch; a pair that shares several bins comes from the first
    of these, which is the later one of the two starts."""
    other = _in_bins(right, start, end, width).withColumnsRenamed({c: f"{c}_2" for c in right.columns} | {BIN: "__piece"})
    key = F.lit(True)
    for k in on:
        key = key & (F.col(k) == F.col(f"{k}_2"))
    first = F.greatest(day_bin(start, width), day_bin(f"{start}_2", width))
    found = _in_bins(left, start, end, width).join(
        other, key & (F.col(BIN) == F.col("__piece")) & (F.col(start) < F.col(f"{end}_2")) & (F.col(f"{start}_2") < F.col(end))
        & (F.col(BIN) == first))
    return found.drop(BIN, "__piece")
