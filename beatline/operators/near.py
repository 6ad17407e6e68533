"""Counts of events near others in space and time: within some km and some days.

Events of one place and day count as one row. Places are points of the unit sphere, so neither the poles nor
the date line are special, and lie in cubes somewhat wider than the distance; days lie in bins. Each row of
``others`` is copied to the cubes that its ball touches and to the bins that its days touch, each
row of ``facts`` lies in one cube and bin, and the two meet by an equi-join with the exact condition beside it, so a pair
comes once. Only counts leave the join, summed in the tasks before they are shuffled.

The sum is grouped by place and day alone, so there is a shuffle of partial counts behind the join, and adaptive
execution may split a cube that is too full over several tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.functions.geo import EARTH_RADIUS_KM, haversine_km
from beatline.operators.joins import with_strategy

AXES = ("__x", "__y", "__z")
CELL = ("__cx", "__cy", "__cz", "__bin")


def _spots(events: DataFrame, lat: str, lon: str, at: str) -> DataFrame:
    """lat, lon, day (since 1970), ``n`` events and the point of the sphere; events without a place or time are left out."""
    known = (F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(at).isNotNull()
             & ~F.isnan(F.col(lat).cast("double")) & ~F.isnan(F.col(lon).cast("double")))
    counted = events.where(known).groupBy(
        F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"),
        F.unix_date(F.col(at).cast("date")).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    y, x = F.radians("lat"), F.radians("lon")
    return counted.select("*", (F.cos(y) * F.cos(x)).alias("__x"), (F.cos(y) * F.sin(x)).alias("__y"), F.sin(y).alias("__z"))


def counts_within(facts: DataFrame, others: DataFrame, km: float, days: int, *, lat: str = "lat", lon: str = "lon",
                  at: str = "at", name: str = "nearby", cube: float = 2.0, bin_days: int | None = None) -> DataFrame:
    """lat, lon, day, crime_count (the ``facts`` of that place and day) and ``name``: how many of ``others`` lie at most
    ``km`` (great circle) and ``days`` calendar days from there; 0 where none does.

    With one table as both, an event counts itself. Rows without a place or time are in neither count. ``cube`` (in
    distances) and ``bin_days`` only deal the work out: wider ones make fewer copies and more comparisons."""
    chord = 2 * math.sin(min(km / (2 * EARTH_RADIUS_KM), math.pi / 2)) * (1 + 1e-9) + 1e-9
    size, width = max(cube * chord, 1e-6), bin_days or max(1, 2 * days)
    asked = _spots(facts, lat, lon, at).select(
        "lat", "lon", "day", F.col("n").alias("crime_count"), *[F.floor(F.col(a) / size).alias(c) for a, c in zip(AXES, CELL)],
        F.floor(F.col("day") / width).alias("__bin"))
    copies = _spots(others, lat, lon, at).withColumn(
        "__bin", F.explode(F.sequence(F.floor((F.col("day") - days) / width), F.floor((F.col("day") + days) / width))))
    for axis, cell in zip(AXES, CELL):
        copies = copies.withColumn(cell, F.explode(F.sequence(
            F.floor((F.col(axis) - chord) / size), F.floor((F.col(axis) + chord) / size))))
    # Of the cubes around the ball those that it touches and that hold a part of the sphere.
    away, least, most = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for axis, cell in zip(AXES, CELL):
        low, high = F.col(cell) * size, (F.col(cell) + 1) * size
        away = away + F.pow(F.greatest(low - F.col(axis), F.col(axis) - high, F.lit(0.0)), 2.0)
        least = least + F.pow(F.greatest(low, -high, F.lit(0.0)), 2.0)
        most = most + F.pow(F.greatest(-low, high), 2.0)
    copies = copies.where((away <= chord * chord) & (least <= 1 + 1e-9) & (most >= 1 - 1e-9)).select(
        *CELL, F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), F.col("day").alias("__day"), F.col("n").alias("__n"))
    near = F.abs(F.col("day") - F.col("__day")) <= days
    same = [asked[c] == copies[c] for c in CELL]
    # Spark's estimate knows nothing of the copies and would have them all broadcast.
    copies = with_strategy(copies, "merge")
    met = asked.join(copies, [*same, near, haversine_km("lat", "lon", "__lat", "__lon") <= km], "left")
    return met.groupBy("lat", "lon", "day", "crime_count").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias(name)).select(
        "lat", "lon", F.date_from_unix_date("day").alias("day"), "crime_count", name)
