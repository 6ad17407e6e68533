"""Operators on hand-written rows, checked against brute force in Python."""

import math
import random

import pandas as pd
from pyspark.sql import functions as F

from beatline.functions.geo import EARTH_RADIUS_KM
from beatline.operators import (
    nearest_distance, nearest_station, profile, rank_within, top_and_bottom,
    top_k, with_udf,
)
from beatline.plans import queries as Q


def _hav(lat1, lon1, lat2, lon2):
    """Distance by the chord between two points of the sphere."""
    def point(lat, lon):
        t, p = math.radians(lat), math.radians(lon)
        return math.cos(t) * math.cos(p), math.cos(t) * math.sin(p), math.sin(t)
    return EARTH_RADIUS_KM * 2 * math.asin(min(1.0, math.dist(point(lat1, lon1), point(lat2, lon2)) / 2))


def _close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


def test_rank_ties_keep_more_than_k(spark):
    df = spark.createDataFrame([(2020, m, c) for m, c in enumerate([5, 4, 3, 3, 2], 1)],
                               "year int, month int, crime_count long")
    got = sorted((r.month, r.rank) for r in rank_within(df, ["year"], "crime_count", "rank", 3).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 3)]


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([(90003, 10.0), (90001, 10.0), (90002, 5.0), (90004, None)],
                               "zip int, income float")
    assert [r.zip for r in top_k(df, "income", 2, tie_break=["zip"]).collect()] == [90001, 90003]
    dropped = top_k(df, "income", 1, descending=False, tie_break=["zip"], drop_nulls=True).collect()
    assert [r.zip for r in dropped] == [90002]
    assert [r.zip for r in top_k(df, "income", 1, descending=False, tie_break=["zip"]).collect()] == [90004]


def test_top_and_bottom_overlap(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)], "zip int, income double")
    got = sorted(r.zip for r in top_and_bottom(df, "income", 3, keep=["zip"], tie_break=["zip"]).collect())
    assert got == [1, 2, 2, 3, 3, 4]


def test_known_income_file(spark):
    from conftest import DATA
    from beatline.sources import read_incomes_csv
    inc = read_incomes_csv(spark, f"{DATA}/income_2015_sample.csv")
    sel = [r.zip for r in Q.extreme_areas(inc).collect()]
    assert sel[:3] == [90272, 90077, 91210]
    assert sel[3:] == [90021, 91046, 90058]


def _stations(spark, rows):
    return spark.createDataFrame(rows, "fid int, division string, y double, x double")


def test_nearest_tie_goes_to_lower_key(spark):
    st = _stations(spark, [(2, "B", 34.0, -118.0 + 0.5), (1, "A", 34.0, -118.0 - 0.5), (3, "C", 40.0, -100.0)])
    facts = spark.createDataFrame([(1, 34.0, -118.0), (2, None, -118.0)], "id int, lat double, lon double")
    out = {r.id: r.n for r in nearest_station(facts, st, out="n").collect()}
    assert out[1].division == "A" and out[1].key == 1
    assert out[2] is None


def test_nearest_skips_null_station_coordinates(spark):
    st = _stations(spark, [(1, "A", None, None), (2, "B", 35.0, -118.0)])
    facts = spark.createDataFrame([(1, 34.0, -118.0)], "id int, lat double, lon double")
    assert nearest_station(facts, st, out="n").first().n.division == "B"


def _brute(f_rows, st_rows):
    out = {}
    for i, la, lo in f_rows:
        known = [(_hav(la, lo, y, x), fid) for fid, _, y, x in st_rows if la is not None and y is not None]
        out[i] = min(known) if known else None
    return out


def _same(df, expect):
    got = {r.id: r.n for r in df.collect()}
    assert got.keys() == expect.keys()
    for i, e in expect.items():
        assert (got[i] is None) == (e is None)
        assert e is None or (_close(got[i].dist, e[0]) and got[i].key == e[1])


def test_nearest_matches_brute_force(spark):
    """Stations all over the world, some without a position; places with none."""
    rnd = random.Random(7)
    for size in (1, 2, 7, 91, 400):
        st_rows = [(i, f"D{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(1, size + 1)]
        st_rows.append((size + 1, "NULL", None, -118.0))
        f_rows = [(i, None if i % 13 == 0 else rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(200)]
        facts = spark.createDataFrame(f_rows, "id int, lat double, lon double")
        _same(nearest_station(facts, _stations(spark, st_rows), out="n"), _brute(f_rows, st_rows))


def test_nearest_with_many_identical_stations(spark):
    """Any number of stations at one place are one, with the lowest key."""
    st = _stations(spark, [(i, "SAME", 34.0, -118.0) for i in range(1, 42)] + [(99, "OTHER", 35.0, -118.0)])
    facts = spark.createDataFrame([(1, 34.1, -118.0), (2, 34.9, -118.0)], "id int, lat double, lon double")
    got = {r.id: (r.n.key, r.n.division) for r in nearest_station(facts, st, out="n").collect()}
    assert got == {1: (1, "SAME"), 2: (99, "OTHER")}


def test_nearest_at_the_antipode_and_without_stations(spark):
    rnd = random.Random(5)
    f_rows = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 0)) for i in range(2000)]
    facts = spark.createDataFrame(f_rows, "id int, lat double, lon double")
    pairs = facts.select("id", "lat", "lon", (-F.col("lat")).alias("y"), (F.col("lon") + 180).alias("x"))
    from beatline.functions import haversine_km
    far = pairs.select(haversine_km("lat", "lon", "y", "x").alias("d")).collect()
    assert all(r.d is not None and abs(r.d - math.pi * EARTH_RADIUS_KM) < 1 for r in far)
    assert all(r.n is None for r in nearest_station(facts, _stations(spark, []), out="n").collect())


def test_nearest_distance_null_coordinates(spark):
    st = _stations(spark, [(1, "A", 34.0, -118.0)])
    facts = spark.createDataFrame([(1, 34.0, -118.0), (2, None, None)], "id int, lat double, lon double")
    got = {r.id: r.d for r in nearest_distance(facts, st, out="d").collect()}
    assert got == {1: 0.0, 2: None}


def test_area_distance_default_point(spark):
    st = spark.createDataFrame([(1, 1, "A", 34.0, -118.0)], "fid int, prec int, division string, y double, x double")
    facts = spark.createDataFrame([(1, 1, 34.0, -118.0), (2, 9, 34.0, -118.0)], "incident_id int, area_id int, lat double, lon double")
    got = {r.incident_id: r.distance for r in Q.with_area_distance(facts, st).collect()}
    assert got[1] == 0.0
    assert math.isclose(got[2], _hav(34.0, -118.0, 0.0, 0.0), rel_tol=1e-12)


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a int, `b c` string")
    got = {r.column_name: (r.data_type, r.non_null, r.row_count) for r in profile(df).collect()}
    assert got == {"a": ("int", 2, 3), "b c": ("string", 2, 3)}


def test_with_udf_both_modes(spark):
    df = spark.createDataFrame([("B",), (None,)], "c string")
    vec = with_udf(df, "n", lambda s: s.fillna("").str.len(), "long", "c")
    row = with_udf(df, "n", lambda v: 0 if v is None else len(v), "long", "c", vectorized=False)
    assert [r.n for r in vec.collect()] == [1, 0]
    assert [r.n for r in row.collect()] == [1, 0]
    assert isinstance(pd.Series([1]), pd.Series)


def test_broadcast_is_bounded_by_bytes(spark):
    from beatline.operators import estimated_bytes, with_strategy
    small = spark.range(5)
    assert 0 < estimated_bytes(small) < 1000
    for most, marked in ((1000, True), (1, False)):
        j = spark.range(100).join(with_strategy(small, "broadcast", most), "id")
        assert ("broadcast" in j._jdf.queryExecution().analyzed().toString().lower()) == marked
        assert j.count() == 5


def test_poorest_areas_without_income_come_first(spark):
    inc = spark.createDataFrame([(1, "$5"), (2, "---"), (3, "$1"), (4, "$9")], "zip int, income_text string")
    assert [r.zip for r in Q.extreme_areas(inc, 2).collect()] == [4, 1, 2, 3]
    assert [r.zip for r in Q.extreme_areas(inc, 2, drop_nulls=True).collect()] == [4, 1, 3, 1]


def test_extreme_areas_distinct_and_aliases(spark):
    inc = spark.createDataFrame([(1, "$1"), (2, "$2")], "zip int, income_text string")
    assert sorted(r.zip for r in Q.extreme_areas(inc, 3).collect()) == [1, 1, 2, 2]
    assert sorted(r.zip for r in Q.extreme_areas(inc, 3, distinct=True).collect()) == [1, 2]
    st = spark.createDataFrame([(1, 1, "NORTH HOLLYWOOD", 34.0, -118.0)],
                               "fid int, prec int, division string, y double, x double")
    facts = spark.createDataFrame([(1, "N Hollywood", 100, 34.0, -118.0)],
                                  "incident_id int, area_name string, weapon_code int, lat double, lon double")
    plain = Q.division_distance_stats(facts, st).first()
    mapped = Q.division_distance_stats(facts, st, aliases={"N HOLLYWOOD": "NORTH HOLLYWOOD"}).first()
    assert plain.average_distance is None and mapped.average_distance == "0.000"


def test_write_table(spark, tmp_path):
    from beatline.sources.sinks import write_table
    write_table(spark.range(3), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_cluster_conf_sizes_partitions():
    from beatline.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(10 ** 6, 8)["spark.sql.shuffle.partitions"]) == 16
