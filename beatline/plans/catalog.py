"""Registered questions: name → ``(spark, sf_dir) → DataFrame`` on the stand-in views.

Every entry derives its inputs from whole driver tables (``sources.standins``)
when it is called, so its work grows with the scale factor. Entries about CSV
files or text lines write those files first and read them back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.functions import day_segment, label_of, thousands
from beatline.operators import (
    code_between, containing, in_year, not_null, profile, row_count, top_k, with_udf,
)
from beatline.operators.changes import change_set
from beatline.operators.nearest import nearest_station
from beatline.plans import queries as Q
from beatline.sources import drop_header, read_incidents_csv, union_periods
from beatline.sources import standins as S
from beatline.sources.csv import update_incidents_parquet, write_incidents_parquet
from beatline.streaming import incident_stream, late_counts, run_closed, run_late, windowed_counts_stream

Query = Callable[[SparkSession, str], DataFrame]

YEAR = S.STANDIN_YEAR


# --- composites -------------------------------------------------------------------

def top_months_by_count(spark, sf_dir):
    return Q.top_months_by_count(S.incidents(spark, sf_dir))


def top_months_by_count_sql(spark, sf_dir):
    return Q.top_months_by_count_sql(S.incidents(spark, sf_dir))


def top_months_by_count_csv(spark, sf_dir):
    """From the two period files: read, united, dates parsed, counted."""
    return Q.top_months_by_count(S.incidents_csv(spark, sf_dir))


def day_segment_counts_csv(spark, sf_dir):
    return Q.day_segment_counts(S.incidents_csv(spark, sf_dir))


def incidents_per_month(spark, sf_dir):
    return Q.monthly_counts(S.incidents(spark, sf_dir))


def day_segment_counts(spark, sf_dir):
    return Q.day_segment_counts(S.incidents(spark, sf_dir))


def day_segment_counts_lines(spark, sf_dir):
    return Q.day_segment_counts_lines(S.incident_lines(spark, sf_dir), S.FIRST_HEADER)


def category_counts_extreme_areas(spark, sf_dir, strategy="auto"):
    return Q.category_counts_extreme_areas(
        S.incidents(spark, sf_dir), S.build_geocodes(spark, sf_dir), S.build_incomes(spark, sf_dir),
        YEAR, strategy=strategy)


def yearly_area_distance(spark, sf_dir):
    return Q.yearly_area_distance(S.incidents(spark, sf_dir), S.build_stations(spark, sf_dir))


def division_distance_stats(spark, sf_dir, strategy="auto"):
    return Q.division_distance_stats(S.incidents(spark, sf_dir), S.build_stations(spark, sf_dir),
                                     strategy=strategy)


def yearly_nearest_distance(spark, sf_dir):
    return Q.yearly_nearest_distance(S.incidents(spark, sf_dir), S.build_stations(spark, sf_dir))


def nearest_division_stats(spark, sf_dir):
    return Q.nearest_division_stats(S.incidents(spark, sf_dir), S.build_stations(spark, sf_dir))


def nearest_post(spark, sf_dir):
    """Each incident's nearest post and the distance in metres, among posts that grow with the scale."""
    n = nearest_station(S.incidents(spark, sf_dir), S.build_posts(spark, sf_dir), keep=("post",), out="n")
    return n.select("incident_id", F.col("n.post").alias("post"), F.round(F.col("n.dist") * 1000).cast("long").alias("metres"))


def post_workload(spark, sf_dir):
    return Q.post_workload(S.incidents(spark, sf_dir), S.build_posts(spark, sf_dir))


# --- joins by time --------------------------------------------------------------------

def income_at_incident(spark, sf_dir):
    return Q.income_at_incident(S.incidents(spark, sf_dir), S.build_geocodes(spark, sf_dir), S.build_estimates(spark, sf_dir))


def incidents_under_watch(spark, sf_dir):
    return Q.incidents_under_watch(S.incidents(spark, sf_dir), S.build_watches(spark, sf_dir))


def rolling_area_counts(spark, sf_dir):
    return Q.rolling_area_counts(S.incidents(spark, sf_dir))


def place_sessions(spark, sf_dir):
    return Q.place_sessions(S.incidents(spark, sf_dir))


def overlapping_watches(spark, sf_dir):
    return Q.overlapping_watches(S.build_watches(spark, sf_dir))


# --- near in space and time, levels, releases ---------------------------------------------

def crowded_places(spark, sf_dir):
    return Q.crowded_places(S.incidents(spark, sf_dir))


def posts_nearby(spark, sf_dir):
    return Q.posts_nearby(S.incidents(spark, sf_dir), S.build_posts(spark, sf_dir), S.build_watches(spark, sf_dir))


def incident_cube(spark, sf_dir):
    return Q.incident_cube(S.incidents(spark, sf_dir))


def incident_rollup(spark, sf_dir):
    return Q.incident_rollup(S.incidents(spark, sf_dir))


def yearly_from_months(spark, sf_dir):
    """Per year: incidents, distinct places, and the median and ninth decile of the metres to the area's station,
    from summaries by month that were stored before; the incidents are not read again."""
    path = S.new_folder(spark, "months")
    Q.monthly_summaries(S.incidents(spark, sf_dir), S.build_stations(spark, sf_dir)).write.parquet(path)
    return Q.yearly_from_months(spark.read.parquet(path))


def release_changes(spark, sf_dir):
    """Which incidents the next release adds, removes or alters."""
    return change_set(S.incidents(spark, sf_dir), S.build_next_release(spark, sf_dir), ["incident_id"])


def release_update(spark, sf_dir):
    """The stored table of the first release after the years that the next one changes were written anew."""
    old, new, path = S.incidents(spark, sf_dir), S.build_next_release(spark, sf_dir), S.new_folder(spark, "release")
    write_incidents_parquet(old, path)
    update_incidents_parquet(old, new, change_set(old, new, ["incident_id"]), path)
    return S.core(spark.read.parquet(path))


# --- streams --------------------------------------------------------------------------

def _streamed(spark, sf_dir, run):
    """Runs a stream after each delivery into a new folder; the state goes on from run to run."""
    folder = S.new_folder(spark, "stream")
    for rows in S.deliveries(spark, sf_dir):
        rows.write.mode("append").parquet(f"{folder}/in")
        run(incident_stream(spark, f"{folder}/in", rows.schema), folder)
    return folder


def weekly_area_counts_stream(spark, sf_dir):
    """Incidents by week and area, each once, in the weeks that the watermark has closed."""
    folder = _streamed(spark, sf_dir, lambda events, at: run_closed(windowed_counts_stream(
        events, "occurred_at", "7 days", keys=("area_id",), event_id="incident_id"), f"{at}/out", f"{at}/state"))
    return spark.read.parquet(f"{folder}/out")


def sliding_counts_stream(spark, sf_dir):
    """Incidents in four weeks, each week anew, every arrival counted."""
    folder = _streamed(spark, sf_dir, lambda events, at: run_closed(windowed_counts_stream(
        events, "occurred_at", "28 days", slide="7 days"), f"{at}/out", f"{at}/state"))
    return spark.read.parquet(f"{folder}/out")


def late_counts_stream(spark, sf_dir):
    """Incidents that came after their watermark, by week."""
    folder = _streamed(spark, sf_dir, lambda events, at: run_late(
        events, f"{at}/out", f"{at}/state", "occurred_at", "7 days", event_id="incident_id"))
    return late_counts(f"{folder}/out", spark)


# --- sources and profile -------------------------------------------------------------

def incident_profile(spark, sf_dir):
    """Every column of the typed incident files: type, nullability, non-NULL count."""
    return profile(S.incidents_csv(spark, sf_dir))


def incident_row_count(spark, sf_dir):
    return row_count(S.incidents_csv(spark, sf_dir))


def scan_incidents_csv(spark, sf_dir):
    return S.core(S.incidents_csv(spark, sf_dir))


def typed_incidents(spark, sf_dir):
    """Date texts parsed by pattern, numbers typed (the CSV schema)."""
    return S.incidents_csv(spark, sf_dir).select(
        "incident_id", "reported_on", "occurred_at", "victim_age", "area_id", "lat", "lon")


def scan_stations(spark, sf_dir):
    """A file with a byte order mark and the columns in another order."""
    return S.stations_csv(spark, sf_dir)


def scan_incomes(spark, sf_dir):
    return S.incomes_csv(spark, sf_dir)


def scan_geocodes(spark, sf_dir):
    return S.geocodes_csv(spark, sf_dir)


def scan_lines(spark, sf_dir):
    """Whole lines of both files, every header line dropped."""
    lines = S.incident_lines(spark, sf_dir)
    return drop_header(drop_header(lines, S.FIRST_HEADER), S.SECOND_HEADER)


def all_incidents(spark, sf_dir):
    """The two period files, each read on its own, as one table."""
    return union_periods(*(S.core(read_incidents_csv(spark, p)) for p in S.incident_csv_paths(spark, sf_dir)))


# --- filters --------------------------------------------------------------------------

def armed_incidents(spark, sf_dir):
    return S.core(not_null(S.incidents(spark, sf_dir), "weapon_code"))


def incidents_in_year(spark, sf_dir):
    return S.core(not_null(in_year(S.incidents(spark, sf_dir), "occurred_at", YEAR), "category"))


def street_incidents(spark, sf_dir):
    return S.core(containing(S.incidents(spark, sf_dir), "premises", Q.STREET_TEXT))


def firearm_incidents(spark, sf_dir):
    return S.core(code_between(S.incidents(spark, sf_dir), "weapon_code", *Q.FIREARM_CODES))


# --- scalar functions and joins, per row ------------------------------------------------

def day_segments(spark, sf_dir):
    return S.incidents(spark, sf_dir).select(
        "incident_id", "time_hhmm", day_segment("time_hhmm").alias("day_segment"))


def category_labels(spark, sf_dir):
    return S.incidents(spark, sf_dir).select(
        "incident_id", "category", label_of("category").alias("label"))


def parse_money(spark, sf_dir):
    return Q.incomes_parsed(S.build_incomes(spark, sf_dir)).select("zip", "income_text", "income")


def geocode_incidents(spark, sf_dir):
    facts = S.incidents(spark, sf_dir).select("incident_id", "lat", "lon")
    return Q.geocoded(facts, S.build_geocodes(spark, sf_dir))


def incident_station_distance(spark, sf_dir):
    d = Q.with_area_distance(S.incidents(spark, sf_dir), S.build_stations(spark, sf_dir))
    return d.select("incident_id", "area_id", thousands("distance", 3).alias("distance"))


def nearest_station_per_incident(spark, sf_dir):
    n = nearest_station(S.incidents(spark, sf_dir), S.build_stations(spark, sf_dir), keep=("division",), out="n")
    return n.select("incident_id", F.col("n.division").alias("division"),
                    thousands(F.col("n.dist"), 3).alias("distance"))


def richest_areas(spark, sf_dir):
    inc = Q.incomes_parsed(S.build_incomes(spark, sf_dir))
    return top_k(inc, "income", Q.EXTREME_AREAS, tie_break=["zip"]).select("zip", "income")


def poorest_areas(spark, sf_dir):
    inc = Q.incomes_parsed(S.build_incomes(spark, sf_dir))
    return top_k(inc, "income", Q.EXTREME_AREAS, descending=False, tie_break=["zip"]).select("zip", "income")


def extreme_areas(spark, sf_dir):
    return Q.extreme_areas(S.build_incomes(spark, sf_dir))


def custom_row_function(spark, sf_dir):
    """The user hook with a pandas function: in how many digits a number and its reverse differ
    (Spark has no such distance of texts)."""

    # Defined here so it travels to the Python workers by value: they need not
    # be able to import this package.
    def differing_digits(ids):
        texts = ids.astype(str).str.zfill(12)
        return texts.map(lambda t: sum(a != b for a, b in zip(t, reversed(t))))

    inc = S.incidents(spark, sf_dir).select("incident_id", "category")
    return with_udf(inc, "differing_digits", differing_digits, "long", "incident_id")


QUERIES: dict[str, Query] = {
    "top_months_by_count": top_months_by_count,
    "top_months_by_count_sql": top_months_by_count_sql,
    "top_months_by_count_csv": top_months_by_count_csv,
    "incidents_per_month": incidents_per_month,
    "day_segment_counts": day_segment_counts,
    "day_segment_counts_csv": day_segment_counts_csv,
    "day_segment_counts_lines": day_segment_counts_lines,
    "category_counts_extreme_areas": category_counts_extreme_areas,
    "extreme_areas_broadcast": partial(category_counts_extreme_areas, strategy="broadcast"),
    "extreme_areas_merge": partial(category_counts_extreme_areas, strategy="merge"),
    "extreme_areas_shuffle_hash": partial(category_counts_extreme_areas, strategy="shuffle_hash"),
    "yearly_area_distance": yearly_area_distance,
    "division_distance_stats": division_distance_stats,
    "division_distance_broadcast": partial(division_distance_stats, strategy="broadcast"),
    "division_distance_merge": partial(division_distance_stats, strategy="merge"),
    "division_distance_shuffle_hash": partial(division_distance_stats, strategy="shuffle_hash"),
    "yearly_nearest_distance": yearly_nearest_distance,
    "nearest_division_stats": nearest_division_stats,
    "nearest_post": nearest_post,
    "post_workload": post_workload,
    "income_at_incident": income_at_incident,
    "incidents_under_watch": incidents_under_watch,
    "overlapping_watches": overlapping_watches,
    "rolling_area_counts": rolling_area_counts,
    "weekly_area_counts_stream": weekly_area_counts_stream,
    "sliding_counts_stream": sliding_counts_stream,
    "late_counts_stream": late_counts_stream,
    "place_sessions": place_sessions,
    "crowded_places": crowded_places,
    "posts_nearby": posts_nearby,
    "incident_cube": incident_cube,
    "incident_rollup": incident_rollup,
    "yearly_from_months": yearly_from_months,
    "release_changes": release_changes,
    "release_update": release_update,
    "incident_profile": incident_profile,
    "incident_row_count": incident_row_count,
    "scan_incidents_csv": scan_incidents_csv,
    "typed_incidents": typed_incidents,
    "scan_stations": scan_stations,
    "scan_incomes": scan_incomes,
    "scan_geocodes": scan_geocodes,
    "scan_lines": scan_lines,
    "all_incidents": all_incidents,
    "armed_incidents": armed_incidents,
    "incidents_in_year": incidents_in_year,
    "street_incidents": street_incidents,
    "firearm_incidents": firearm_incidents,
    "day_segments": day_segments,
    "category_labels": category_labels,
    "parse_money": parse_money,
    "geocode_incidents": geocode_incidents,
    "incident_station_distance": incident_station_distance,
    "nearest_station": nearest_station_per_incident,
    "richest_areas": richest_areas,
    "poorest_areas": poorest_areas,
    "extreme_areas": extreme_areas,
    "custom_row_function": custom_row_function,
}
