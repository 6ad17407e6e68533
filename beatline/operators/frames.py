"""Rolling counts and sessions over time, without a window that holds all rows of a key.

Time is cut into stretches. A window sees the rows of one key in one stretch, and what
goes beyond a stretch's border travels as a few rows: for rolling counts copies of the last days
before the border, for sessions the first and the last one of each stretch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRETCH = "__stretch"


def rolling_counts(facts: DataFrame, keys: Sequence[str], at: str, days: int, name: str = "crime_count",
                   width: int = 365) -> DataFrame:
    """``keys``, day, ``name`` (the rows of that day) and last_``days``: those of the ``days`` days that end with it.

    Facts are counted by key and day first. A stretch of ``width`` days also gets copies of the
    days before it that its frames reach back to, so any width gives the same rows. Rows without a time are left
    out; days without rows have none."""
    width = max(width, days)
    day = F.unix_date(F.col(at).cast("date"))
    daily = facts.where(F.col(at).isNotNull()).groupBy(*keys, day.alias("__day")).agg(F.count(F.lit(1)).alias(name))
    own = F.floor(F.col("__day") / width)
    reach = F.floor((F.col("__day") + days - 1) / width)  # the stretch of the last day whose frame holds this one
    copied = daily.withColumn(STRETCH, F.explode(F.sequence(own, reach)))
    frame = Window.partitionBy(*keys, STRETCH).orderBy("__day").rangeBetween(-(days - 1), 0)
    counted = copied.withColumn(f"last_{days}", F.sum(name).over(frame)).where(F.col(STRETCH) == own)
    return counted.select(*keys, F.date_from_unix_date("__day").alias("day"), name, f"last_{days}")


def sessions(facts: DataFrame, keys: Sequence[str], at: str, gap_hours: int, width: int = 365) -> DataFrame:
    """``keys``, start_at, end_at and events of each series of rows of a key in which no two neighbours lie more than
    ``gap_hours`` apart.

    Sessions are found within stretches of ``width`` days; only the first and the last of each can go on in
    the stretch beside it, and these are tied in a second step. Rows without a key or time are left out."""
    known = F.lit(True)
    for c in [*keys, at]:
        known = known & F.col(c).isNotNull()
    rows = facts.where(known).groupBy(*keys, F.col(at).alias("__at")).agg(F.count(F.lit(1)).alias("events")).withColumn(
        STRETCH, F.floor(F.unix_date(F.col("__at").cast("date")) / width))

    def numbered(df: DataFrame, start: str, end: str, within: list[str]) -> DataFrame:
        """A number for each series of neighbours, among the rows of ``within``."""
        order = Window.partitionBy(*within).orderBy(start)
        far = F.timestamp_diff("SECOND", F.lag(end).over(order), F.col(start)) > gap_hours * 3600
        return df.withColumn("__new", F.coalesce(far, F.lit(False)).cast("int")).withColumn(
            "__series", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    inside = [*keys, STRETCH]
    local = numbered(rows, "__at", "__at", inside).groupBy(*inside, "__series").agg(
        F.min("__at").alias("start_at"), F.max("__at").alias("end_at"), F.sum("events").alias("events")).withColumn("__last", F.max("__series").over(Window.partitionBy(*inside)))
    border = (F.col("__series") == 0) | (F.col("__series") == F.col("__last"))
    out = [*keys, "start_at", "end_at", "events"]
    tied = numbered(local.where(border).select(*out), "start_at", "end_at", list(keys)).groupBy(*keys, "__series").agg(
        F.min("start_at").alias("start_at"), F.max("end_at").alias("end_at"), F.sum("events").alias("events"))
    return tied.select(*out).unionByName(local.where(~border).select(*out))
