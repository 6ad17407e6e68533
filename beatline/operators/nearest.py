"""Nearest-station lookup by spatial cells.

The stations, one per position, are put into cells of ever finer grids (8, 1/2 and 1/32
degrees). A cell knows the box around its stations and one of them. The distinct places of the
facts go down the grids, one equi-join a grid: a place meets the cells inside those that it
has left, its distance to each cell's station bounds the nearest one from above, the cell's
box from below, and cells whose box lies beyond the least upper bound are dropped. The
stations of the cells that are left after the last grid are compared exactly. Nothing is
held in one row, and both sides are dealt out: a place meets some cells a grid, whatever the
number of stations, and far places prune by the same boxes as near ones.

Only the coarsest grid is broadcast; its indices are cut to the globe, so it has at most
COARSE cells. Facts that share a place are looked up once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.functions.geo import EARTH_RADIUS_KM

#: Widths of the cells in degrees, coarsest first.
GRIDS = (8.0, 0.5, 0.03125)
#: The most cells that the coarsest grid can have.
COARSE = (int(180 / GRIDS[0]) + 1) * (int(360 / GRIDS[0]) + 1)


def _cell(size: float) -> str:
    """The number of the cell of (y, x); positions off the globe count into its outermost cells."""
    high, wide = int(180 / size), int(360 / size)
    return (f"CAST(greatest(0, least({high}, floor((y + 90) / {size}D))) * {wide + 1} "
            f"+ greatest(0, least({wide}, floor((x + 180) / {size}D))) AS BIGINT)")


def _km(y: str, x: str) -> str:
    """Great-circle distance from the place (lat, lon), as ``haversine_km`` has it; NaN counts as none."""
    a = (f"(sin(radians({y} - lat) / 2) * sin(radians({y} - lat) / 2) + cos(radians(lat)) * cos(radians({y}))"
         f" * sin(radians({x} - lon) / 2) * sin(radians({x} - lon) / 2))")
    return f"nanvl({EARTH_RADIUS_KM}D * 2 * atan2(sqrt({a}), sqrt(greatest(0D, 1 - {a}))), NULL)"


#: A distance (km) that no station of the box (low_y, high_y, low_x, high_x) lies within; 0 off the globe.
_OUTSIDE = f"""CASE WHEN abs(lat) <= 90 AND low_y >= -90 AND high_y <= 90 AND abs(lon) <= 360 AND low_x >= -180 AND high_x <= 180
  THEN 2 * {EARTH_RADIUS_KM}D * asin(sqrt(least(1D, power(sin(radians(greatest(low_y - lat, lat - high_y, 0D)) / 2), 2)
    + cos(radians(lat)) * least(cos(radians(low_y)), cos(radians(high_y))) * power(sin(radians(
      CASE WHEN lon BETWEEN low_x AND high_x THEN 0D ELSE least(pmod(low_x - lon, 360D), 360D - pmod(low_x - lon, 360D),
        pmod(high_x - lon, 360D), 360D - pmod(high_x - lon, 360D)) END) / 2), 2)))) ELSE 0D END"""


def _search_sql(kept: list[str], carried: list[str]) -> str:
    """Places and stations to the nearest station of each place, grid after grid, as one statement. Places
    without a position meet no cell and are kept."""
    last = len(GRIDS) - 1
    names, place = "".join(f", {k}" for k in kept), ", ".join(["lat", "lon", *carried])
    known = "{y} IS NOT NULL AND {x} IS NOT NULL AND NOT isnan({y}) AND NOT isnan({x})"
    steps = [
        f"points AS (SELECT y, x, min(struct(key{names})) AS entry, "
        + ", ".join(f"{_cell(size)} AS c{g}" for g, size in enumerate(GRIDS))
        + f" FROM {{stations}} WHERE {known.format(y='y', x='x')} GROUP BY y, x)",
        f"left0 AS (SELECT {place}, CASE WHEN {known.format(y='lat', x='lon')} THEN 0 END AS parent, "
        "double('infinity') AS bound FROM {places})"]
    for g in range(len(GRIDS)):
        above = f"c{g - 1}" if g else "min(least(c0, 0))"  # 0, but not to the optimizer: the coarsest grid is met by a hash join
        by = f"c{g - 1}, c{g}" if g else "c0"
        steps += [
            f"grid{g} AS (SELECT {above} AS parent, c{g} AS cell, min(y) AS low_y, max(y) AS high_y, min(x) AS low_x, "
            f"max(x) AS high_x, min(struct(y, x)) AS some FROM points GROUP BY {by})",
            f"met{g} AS (SELECT {'/*+ BROADCAST(grid0) */' if g == 0 else ''} {place}, cell, bound, {_OUTSIDE} AS low, "
            f"coalesce({_km('some.y', 'some.x')}, double('infinity')) AS high FROM left{g} LEFT JOIN grid{g} USING (parent))",
            f"left{g + 1} AS (SELECT {place}, cell AS parent, best AS bound FROM (SELECT *, least(bound, min(high) "
            f"OVER (PARTITION BY lat, lon)) AS best FROM met{g}) WHERE cell IS NULL OR low <= best * (1 + 1e-9D) + 1e-6D)"]
    steps.append(f"near AS (SELECT {place}, {_km('y', 'x')} AS dist, entry FROM left{last + 1} LEFT JOIN points ON parent = c{last})")
    entry = "".join(f", entry.{k}" for k in ["key", *kept])
    return (f"WITH {', '.join(steps)} SELECT {place}, min(CASE WHEN dist IS NOT NULL THEN struct(dist{entry}) END) AS nearest "
            f"FROM near GROUP BY {place}")


def nearest_of_places(places: DataFrame, stations: DataFrame, *, lat: str = "lat", lon: str = "lon", key: str = "fid",
                      keep: tuple[str, ...] = ("division",), out: str = "nearest") -> DataFrame:
    """Add ``out`` as :func:`nearest_station` to ``places``, which have a row for each (lat, lon).
    Stations at one position count as the one with the lowest key, then the lowest kept values."""
    carried = [c for c in places.columns if c not in (lat, lon, out)]
    kept, held = [f"k{i}" for i in range(len(keep))], [f"p{i}" for i in range(len(carried))]
    found = places.sparkSession.sql(
        _search_sql(kept, held),
        places=places.select(F.col(f"`{lat}`").alias("lat"), F.col(f"`{lon}`").alias("lon"),
                             *[F.col(f"`{c}`").alias(n) for c, n in zip(carried, held)]),
        stations=stations.select("y", "x", F.col(f"`{key}`").alias("key"), *[
            F.col(f"`{k}`").alias(n) for k, n in zip(keep, kept)]))
    best = F.struct("nearest.dist", "nearest.key", *[F.col(f"nearest.{n}").alias(k) for k, n in zip(keep, kept)])
    return found.select(F.col("lat").alias(lat), F.col("lon").alias(lon), *[F.col(n).alias(c) for c, n in zip(carried, held)],
                        F.when(F.col("nearest").isNotNull(), best).alias(out))


def nearest_station(facts: DataFrame, stations: DataFrame, *, lat: str = "lat", lon: str = "lon",
                    key: str = "fid", keep: tuple[str, ...] = ("division",),
                    out: str = "nearest") -> DataFrame:
    """Add ``out: struct<dist double, key, *keep>``: the nearest station to
    (lat, lon) among ``stations(y, x, key, *keep)``.

    Ties go to the lowest ``key``; stations or facts with NULL coordinates
    give no distance; with no distance at all ``out`` is NULL.
    """
    places = facts.select(lat, lon).where(f"`{lat}` IS NOT NULL AND `{lon}` IS NOT NULL").distinct()
    found = nearest_of_places(places, stations, lat=lat, lon=lon, key=key, keep=keep, out=out)
    kept = [c for c in facts.columns if c != out]
    return facts.select(*[F.col(f"`{c}`") for c in kept]).join(found, [lat, lon], "left").select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{out}`"))


def nearest_distance(facts: DataFrame, stations: DataFrame, *, lat: str = "lat", lon: str = "lon",
                     out: str = "nearest_distance") -> DataFrame:
    """Add the distance (km, double) to the nearest station; NULL coordinates → NULL."""
    tmp = f"__{out}"
    return (nearest_station(facts, stations, lat=lat, lon=lon, keep=(), out=tmp)
            .withColumn(out, F.col(f"{tmp}.dist")).drop(tmp))
