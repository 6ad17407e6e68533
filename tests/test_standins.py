"""Each stand-in view: the Spark recipe and its DuckDB SQL give the same rows."""

import os

import duckdb
import pytest
from conftest import SF_SMALL
from test_oracle import _rows

from beatline.plans import oracle as O
from beatline.sources import standins as S

VIEWS = {
    "incidents": (S.build_incidents, O.INCIDENTS),
    "stations": (S.build_stations, O.STATIONS),
    "incomes": (S.build_incomes, O.INCOMES),
    "geocodes": (S.build_geocodes, O.GEOCODES),
}


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_view_recipe_matches_sql(spark, name):
    build, sql = VIEWS[name]
    con = duckdb.connect()
    for t in ("orders", "nation", "customer"):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    df = build(spark, SF_SMALL)
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, cur.fetchall())


def test_file_inputs_match_recipe(spark):
    """What the questions read back from CSV equals the recipe."""
    inc = S.build_incidents(spark, SF_SMALL)
    cols = list(S.INCIDENT_CORE)
    assert _rows(cols, S.incidents_csv(spark, SF_SMALL).select(*cols).collect()) == _rows(cols, inc.select(*cols).collect())
    assert S.incidents_csv(spark, SF_SMALL, "bad").where("size(bad) > 0").count() == 0
    for read, build in ((S.stations_csv, S.build_stations), (S.incomes_csv, S.build_incomes), (S.geocodes_csv, S.build_geocodes)):
        a, b = read(spark, SF_SMALL), build(spark, SF_SMALL)
        assert _rows(a.columns, a.collect()) == _rows(b.columns, b.select(*a.columns).collect())


def test_fixture_has_teeth(spark):
    """Times past noon, ages, rows without date, time or place, and a hot place."""
    r = S.incidents_csv(spark, SF_SMALL).selectExpr(
        "count_if(hour(occurred_at) >= 12) pm", "count(victim_age) age", "count_if(occurred_at is null) undated",
        "count_if(time_hhmm is null) untimed", "count_if(lat is null) nowhere", "count_if(lat = 0) zero", "count(*) n").first()
    assert min(r) > 0 and r.zero * 10 > r.n
