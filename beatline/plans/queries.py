"""The composite questions, each a lazy DataFrame → DataFrame plan.

Inputs are typed DataFrames with the snake_case columns of ``schemas.py``
(incidents: ``incident_id, occurred_at, time_hhmm, area_id, area_name,
category, weapon_code, premises, lat, lon``; stations: ``x, y, fid, division,
prec``; incomes: ``zip, income_text``; geocodes: ``lat, lon, zip_text``).
No function here runs a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.functions import (
    day_segment, field, first_list_item, haversine_km, label_of, parse_money,
    thousands, to_int,
)
from beatline.operators.frames import rolling_counts, sessions
from beatline.operators.joins import BROADCAST_BYTES, join_dim, with_strategy
from beatline.operators.levels import cube_sets, grouping_levels, rollup_sets
from beatline.operators.near import counts_within
from beatline.operators.nearest import nearest_of_places
from beatline.operators.relational import (
    code_between, containing, count_by, in_year, mean_of_counted, not_null,
    rank_within, sort_by_count, top_and_bottom,
)
from beatline.operators.sketches import estimates, merged, summaries
from beatline.operators.temporal import as_of_join, in_periods, overlapping
from beatline.sources.text import drop_header
from beatline.schemas import PREMISES_FIELD_POS, TIME_FIELD_POS

# --- fixed values: question parameters.
TOP_MONTHS = 3
STREET_TEXT = "STREET"
FIREARM_CODES = (100, 199)
EXTREME_AREAS = 3


# --- Q1 ---------------------------------------------------------------------------

def monthly_counts(incidents: DataFrame, ts: str = "occurred_at") -> DataFrame:
    """Incidents per (year, month); rows without a date are left out."""
    dated = incidents.filter(F.col(ts).isNotNull())
    return count_by(dated, [F.year(ts).alias("year"), F.month(ts).alias("month")])


def top_months_by_count(incidents: DataFrame, ts: str = "occurred_at",
                        top: int = TOP_MONTHS) -> DataFrame:
    """The ``top`` months of each year by incident count (ties share a rank).

    Spark inserts a partial ``WindowGroupLimit`` before the shuffle on year,
    so each task forwards at most ``top`` tied ranks per year.
    """
    ranked = rank_within(monthly_counts(incidents, ts), ["year"], "crime_count", "rank", top)
    return ranked.select("year", "month", "crime_count", "rank").orderBy("year", "rank", "month")


TOP_MONTHS_SQL = """
WITH dated AS (
    SELECT date_part('YEAR', {ts}) AS year, date_part('MONTH', {ts}) AS month
    FROM {view}
    WHERE isnotnull({ts})
),
monthly AS (
    SELECT year, month, count(1) AS crime_count FROM dated GROUP BY ALL
),
placed AS (
    SELECT *, rank() OVER busiest AS rank
    FROM monthly
    WINDOW busiest AS (PARTITION BY year ORDER BY crime_count DESC)
)
SELECT * FROM placed WHERE rank BETWEEN 1 AND {top} ORDER BY year, rank, month
"""


def top_months_by_count_sql(incidents: DataFrame, view: str = "beatline_incidents",
                            ts: str = "occurred_at", top: int = TOP_MONTHS) -> DataFrame:
    """Q1 as SQL text over a temp view (same plan as the DataFrame form)."""
    incidents.createOrReplaceTempView(view)
    return incidents.sparkSession.sql(TOP_MONTHS_SQL.format(view=view, ts=ts, top=int(top)))


# --- Q2 ---------------------------------------------------------------------------

def day_segment_counts(incidents: DataFrame, premises_text: str = STREET_TEXT) -> DataFrame:
    """Incidents whose premises mention ``premises_text``, counted per part of day."""
    street = containing(incidents, "premises", premises_text)
    counted = count_by(street, [day_segment("time_hhmm").alias("day_segment")])
    return sort_by_count(counted, "crime_count", "day_segment")


def day_segment_counts_lines(lines: DataFrame, header: str | None, premises_text: str = STREET_TEXT,
                             value: str = "value") -> DataFrame:
    """Q2 over raw CSV lines: header lines dropped, fields taken by position
    after a split on every comma (a quoted comma shifts later fields)."""
    body = drop_header(lines, header, value)
    fields = body.select(field(value, TIME_FIELD_POS).alias("t"),
                         field(value, PREMISES_FIELD_POS).alias("p"))
    street = fields.filter(F.col("p").contains(premises_text))
    counted = count_by(street, [day_segment(to_int("t")).alias("day_segment")])
    return sort_by_count(counted, "crime_count", "day_segment")


# --- Q3 ---------------------------------------------------------------------------

def incomes_parsed(incomes: DataFrame) -> DataFrame:
    """``income_text`` (``$12,345``) → ``income`` float; non-money text → NULL."""
    return incomes.withColumn("income", parse_money("income_text"))


def extreme_areas(incomes: DataFrame, k: int = EXTREME_AREAS, drop_nulls: bool = False,
                  distinct: bool = False) -> DataFrame:
    """ZIPs of the ``k`` richest and ``k`` poorest areas (≤ 2k rows; income
    ties → lower ZIP first; areas without an income are the poorest, unless
    ``drop_nulls`` leaves them out). A bag union, so with fewer than 2k areas a ZIP
    can appear twice and its incidents count twice; ``distinct`` keeps one."""
    sel = top_and_bottom(incomes_parsed(incomes), "income", k, keep=["zip"],
                         tie_break=["zip"], drop_nulls=drop_nulls)
    return sel.distinct() if distinct else sel


def geocoded(incidents: DataFrame, geocodes: DataFrame, strategy: str | None = "auto",
             max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join incidents to the reverse-geocode table on exact (lat, lon);
    ``zip`` is the first ZIP of the geocode's list (text)."""
    geo = geocodes.select("lat", "lon", first_list_item("zip_text").alias("zip"))
    return incidents.join(with_strategy(geo, strategy, max_bytes), ["lat", "lon"], "left")


def category_counts_extreme_areas(incidents: DataFrame, geocodes: DataFrame, incomes: DataFrame,
                                  year: int, *, k: int = EXTREME_AREAS,
                                  strategy: str | None = "auto", drop_nulls: bool = False,
                                  distinct: bool = False, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Victims of ``year`` by descent label, in the ``k`` richest and ``k``
    poorest ZIP areas.

    Same rows as "incidents ⟕ geocodes on (lat, lon), then ⋈ selected ZIPs", but
    the ≤ 2k selected ZIPs meet the geocode table first, and the incidents are
    counted by place and label before the join, so a place with very many of
    them is one row a label and task.
    """
    selected = extreme_areas(incomes, k, drop_nulls, distinct)
    geo = geocodes.select("lat", "lon", to_int(first_list_item("zip_text")).alias("zip"))
    # ≤ 2k rows by construction, so a small side whatever the data.
    selected = selected.hint(strategy) if strategy in ("merge", "shuffle_hash") else F.broadcast(selected)
    places = geo.join(selected, "zip").select("lat", "lon")
    facts = not_null(in_year(incidents, "occurred_at", year), "category", "lat", "lon")
    counted = count_by(facts, ["lat", "lon", label_of("category").alias("category")], "n")
    matched = join_dim(counted, places, ["lat", "lon"], strategy=strategy, max_bytes=max_bytes)
    return sort_by_count(matched.groupBy("category").agg(F.sum("n").alias("crime_count")), "crime_count", "category")


def income_at_incident(incidents: DataFrame, geocodes: DataFrame, estimates: DataFrame) -> DataFrame:
    """Each incident with the ZIP of its place and the latest income estimate of that ZIP not after its
    time (``since``, ``income``; NULL before the first estimate, without a ZIP or a time)."""
    placed = geocoded(incidents.select("incident_id", "occurred_at", "lat", "lon"), geocodes)
    facts = placed.select("incident_id", "occurred_at", to_int("zip").alias("zip"))
    return as_of_join(facts, estimates, ["zip"], "occurred_at", "since", ["income"])


def incidents_under_watch(incidents: DataFrame, watches: DataFrame) -> DataFrame:
    """Per watch with incidents: how many incidents of its area lie in its period (a watch without an end goes on)."""
    facts = incidents.select("incident_id", "area_id", "occurred_at")
    return in_periods(facts, watches, ["area_id"], "occurred_at", "start_at", "end_at", open_ended=True).groupBy(
        "watch_id").agg(F.count(F.lit(1)).alias("crime_count"))


def overlapping_watches(watches: DataFrame) -> DataFrame:
    """Pairs of watches of one area that share a moment, and how many days."""
    pairs = overlapping(watches, watches, ["area_id"], "start_at", "end_at").where("watch_id < watch_id_2")
    days = F.date_diff(F.least("end_at", "end_at_2").cast("date"), F.greatest("start_at", "start_at_2").cast("date"))
    return pairs.select("area_id", F.col("watch_id").alias("first_id"), F.col("watch_id_2").alias("second_id"), days.alias("days"))


ROLLING_DAYS, SESSION_HOURS = 30, 24 * 60


def rolling_area_counts(incidents: DataFrame) -> DataFrame:
    """Per area and day with incidents: how many that day and in the 30 days that end with it."""
    return rolling_counts(incidents, ["area_id"], "occurred_at", ROLLING_DAYS)


def place_sessions(incidents: DataFrame) -> DataFrame:
    """Series of incidents at one place, of which no two neighbours lie more than 60 days apart."""
    return sessions(incidents, ["lat", "lon"], "occurred_at", SESSION_HOURS)


NEAR_KM, NEAR_DAYS = 2.5, 7


def crowded_places(incidents: DataFrame) -> DataFrame:
    """Per place and day with incidents: how many there, and how many within 2.5 km and 7 days, its own included."""
    facts = incidents.select("lat", "lon", "occurred_at")
    return counts_within(facts, facts, NEAR_KM, NEAR_DAYS, at="occurred_at")


def posts_nearby(incidents: DataFrame, posts: DataFrame, watches: DataFrame) -> DataFrame:
    """Per place and day on which a watch starts at a post: watches that start there, and incidents within 2.5 km and 7 days."""
    # Both sides grow with the scale, and files that are packed well look small enough for a broadcast.
    starts = join_dim(watches, posts, F.col("watch_id") == F.col("fid"), strategy="merge").select(
        F.col("y").alias("lat"), F.col("x").alias("lon"), F.col("start_at").alias("occurred_at"))
    near = counts_within(starts, incidents.select("lat", "lon", "occurred_at"), NEAR_KM, NEAR_DAYS, at="occurred_at")
    return near.withColumnRenamed("crime_count", "watch_count")


def _dimensions(incidents: DataFrame) -> DataFrame:
    return incidents.select(F.year("occurred_at").alias("year"), F.month("occurred_at").alias("month"), "area_id",
                            day_segment("time_hhmm").alias("day_segment"), "victim_age")


def incident_cube(incidents: DataFrame) -> DataFrame:
    """Incidents by every subset of year, month, area and part of day, with the youngest and oldest victim."""
    dims = ["year", "month", "area_id", "day_segment"]
    return grouping_levels(_dimensions(incidents), dims, cube_sets(dims), {
        "crime_count": ("count", F.lit(1)), "youngest": ("min", "victim_age"), "oldest": ("max", "victim_age")})


def incident_rollup(incidents: DataFrame) -> DataFrame:
    """Incidents by year, month and area, by year and month, by year, and in all."""
    dims = ["year", "month", "area_id"]
    return grouping_levels(_dimensions(incidents), dims, rollup_sets(dims))


# --- Q4 ---------------------------------------------------------------------------

def _station_points(stations: DataFrame) -> DataFrame:
    """One (y, x) per precinct (the highest ``fid`` wins a duplicate precinct)."""
    best = stations.groupBy("prec").agg(F.max_by(F.struct("y", "x"), "fid").alias("p"))
    return best.select("prec", F.col("p.y").alias("st_y"), F.col("p.x").alias("st_x"))


def with_area_distance(incidents: DataFrame, stations: DataFrame, default_point=(0.0, 0.0),
                       strategy: str | None = "auto",
                       max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``distance`` (km, double) from each incident to the station of its area;
    an area without a station measures to ``default_point`` (lat, lon)."""
    pts = with_strategy(_station_points(stations), strategy, max_bytes)
    j = incidents.join(pts, incidents["area_id"] == pts["prec"], "left")
    lat0, lon0 = default_point
    return j.withColumn("distance", haversine_km(
        "lat", "lon", F.coalesce("st_y", F.lit(float(lat0))), F.coalesce("st_x", F.lit(float(lon0)))
    )).drop("prec", "st_y", "st_x")


def _by_place(incidents: DataFrame, *keys: str) -> DataFrame:
    """Incidents counted by ``keys`` and place: ``n`` rows, ``ids`` of them with an id."""
    return incidents.groupBy(*keys, "lat", "lon").agg(
        F.count(F.lit(1)).alias("n"), F.count("incident_id").alias("ids"))


def _report(grouped: DataFrame, out_key: str) -> DataFrame:
    return grouped.select(out_key, thousands("mean_distance", 3).alias("average_distance"), "crime_count")


def yearly_area_distance(incidents: DataFrame, stations: DataFrame,
                         strategy: str | None = "auto") -> DataFrame:
    """Per year: mean distance (32-bit, 3 decimals) from firearm incidents to
    the station of their area, and their count. The incidents are counted by
    year, area and place before the join."""
    fire = code_between(incidents, "weapon_code", *FIREARM_CODES).withColumn("year", F.year("occurred_at"))
    d = with_area_distance(_by_place(fire, "year", "area_id"), stations, strategy=strategy)
    d = d.withColumn("distance", F.col("distance").cast("float"))
    means = mean_of_counted(d, ["year"], "distance", "n", "ids", "mean_distance", "crime_count")
    return _report(means, "year").orderBy("year")


def division_distance_stats(incidents: DataFrame, stations: DataFrame,
                            strategy: str | None = "auto",
                            max_bytes: int = BROADCAST_BYTES,
                            aliases: dict[str, str] | None = None) -> DataFrame:
    """Per area name: mean distance from armed incidents to the station whose
    division equals the upper-cased area name, and the count (areas without
    such a station keep their count and get a NULL mean). The incidents are
    counted by area and place before the join, so a hot area is dealt out
    over its places and a hot place is one row a task.

    ``aliases`` maps upper-cased area names to division names where the two
    spellings differ (e.g. ``{"N HOLLYWOOD": "NORTH HOLLYWOOD"}``).
    """
    armed = _by_place(not_null(incidents, "weapon_code"), "area_name")
    st = stations.select("division", F.col("y").alias("st_y"), F.col("x").alias("st_x"))
    key = F.upper(F.col("area_name"))
    if aliases:
        amap = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        key = F.coalesce(F.try_element_at(amap, key), key)
    j = join_dim(armed, st, key == F.col("division"), "left", strategy=strategy, max_bytes=max_bytes)
    j = j.withColumn("distance", haversine_km("lat", "lon", "st_y", "st_x").cast("float"))
    means = mean_of_counted(j, [F.col("area_name").alias("division")], "distance", "n", "ids", "mean_distance", "crime_count")
    return sort_by_count(_report(means, "division"), "crime_count", "division")


def yearly_nearest_distance(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    """Per year: mean distance (32-bit) from firearm incidents to the nearest
    station, and their count. The incidents are counted by year and place, and a place is
    looked up once, with its years."""
    fire = code_between(incidents, "weapon_code", *FIREARM_CODES).withColumn("year", F.year("occurred_at"))
    places = _by_place(fire, "year").groupBy("lat", "lon").agg(F.collect_list(F.struct("year", "n", "ids")).alias("years"))
    d = nearest_of_places(places, stations, keep=())
    d = d.select(F.inline("years"), F.col("nearest.dist").cast("float").alias("distance"))
    means = mean_of_counted(d, ["year"], "distance", "n", "ids", "mean_distance", "crime_count")
    return _report(means, "year").orderBy("year")


def _nearest_stats(incidents: DataFrame, stations: DataFrame, name: str) -> DataFrame:
    """``name`` of the nearest station, mean distance (double) and count of armed incidents, which are
    counted by place before they are looked up."""
    n = nearest_of_places(_by_place(not_null(incidents, "weapon_code")), stations, keep=(name,))
    n = n.select("n", "ids", F.col(f"nearest.{name}").alias(name),
                 F.coalesce(F.col("nearest.dist"), F.lit(float("inf"))).alias("distance"))
    return mean_of_counted(n, [name], "distance", "n", "ids", "mean_distance", "crime_count")


def nearest_division_stats(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    """Per nearest division: mean distance (double) and count of armed
    incidents. An incident without coordinates has no nearest station: it
    counts under a NULL division with distance +inf."""
    g = _nearest_stats(incidents, stations, "division")
    return sort_by_count(_report(g.withColumn("division", F.initcap("division")), "division"), "crime_count", "division")


def post_workload(incidents: DataFrame, posts: DataFrame) -> DataFrame:
    """The same by post, for any number of posts: mean distance and count of the armed incidents
    that a post is the nearest to."""
    return sort_by_count(_report(_nearest_stats(incidents, posts, "post"), "post"), "crime_count", "post")


def monthly_summaries(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    """Per year and month: incidents, a sketch of their places, bins of the metres to the station of their area."""
    rows = with_area_distance(incidents, stations).withColumns({"year": F.year("occurred_at"), "month": F.month("occurred_at")})
    place = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.xxhash64("lat", "lon"))
    return summaries(rows, ["year", "month"], place, F.floor(F.col("distance").cast("double") * 1000))


def yearly_from_months(months: DataFrame) -> DataFrame:
    """Summaries by month, merged to years and read."""
    read = estimates(merged(months, ["year"]), ["year"], {"median_m": 0.5, "ninth_decile_m": 0.9})
    return read.withColumnsRenamed({"times": "crime_count", "distinct_values": "places"})
