"""Changes between releases, and stored years brought up to date."""

import os
from datetime import datetime

import pytest
from conftest import physical_plan

from beatline.operators import change_set
from beatline.sources.csv import update_incidents_parquet, write_incidents_parquet

SCHEMA = "id long, a string, b string, x double, at timestamp_ntz"
T0 = datetime(2001, 2, 3, 4, 5, 6, 7)


def changes(spark, old, new, schema=SCHEMA, key=("id",)):
    out = change_set(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), list(key)).collect()
    assert len(out) == len({r[:-1] for r in map(tuple, out)})
    return {tuple(r)[:-1] if len(key) > 1 else r[0]: r["change"] for r in out}


def test_changes(spark):
    same = (1, "p", None, 0.1, T0)
    old = [same, (2, "p", "q", 1.0, T0), (3, None, "z", None, None), (4, "12", "3", 0.0, T0), (5, "u", "v", 1.0, T0), (6, "~", None, 1.0, T0)]
    new = [same, (2, "p", "q", 1.0000000000000002, T0), (3, "z", None, None, None), (4, "1", "23", 0.0, T0),
           (5, "u", "v", 1.0, T0.replace(microsecond=8)), (6, None, "~", 1.0, T0), (7, None, None, None, None)]
    assert changes(spark, old, new) == {2: "altered", 3: "altered", 4: "altered", 5: "altered", 6: "altered", 7: "added"}
    assert changes(spark, new, old)[7] == "removed" and changes(spark, old, old[::-1]) == {}


def test_repeated_rows_and_null_keys(spark):
    a, b = (1, "a", "", 1.0, T0), (1, "b", "", 1.0, T0)
    assert changes(spark, [a, b, b], [b, a, b]) == {} and changes(spark, [a, b, b], [a, a, b]) == {1: "altered"}
    assert changes(spark, [a], [a, a]) == {1: "altered"}
    none = (None, "a", "b", 1.0, T0)
    assert changes(spark, [none], [none]) == {} and changes(spark, [none], [none[:1] + b[1:]]) == {None: "altered"}
    assert changes(spark, [], [none, a]) == {None: "added", 1: "added"} and changes(spark, [], []) == {}
    two = [(1, None, "x", 1.0, T0), (1, "k", "x", 1.0, T0)]
    assert changes(spark, two, two[:1], key=("id", "a")) == {(1, "k"): "removed"}


def test_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    assert change_set(a, a.select("v", "id"), ["id"]).count() == 0  # by name, in any order
    with pytest.raises(ValueError):
        change_set(a, a.withColumnRenamed("v", "w"), ["id"])
    with pytest.raises(ValueError):
        change_set(*[spark.createDataFrame([(1, [2])], "id int, v array<int>")] * 2, ["id"])


def test_plan_is_one_equi_join_of_narrow_rows(spark):
    a = spark.range(1000).selectExpr("id", "cast(id as string) as v", "repeat('w', 100) as w")
    df = change_set(a, a.where("id % 2 = 0"), ["id"])
    assert df.count() == 500
    plan = physical_plan(df)
    assert "FullOuter" in plan and "NestedLoop" not in plan
    assert all("w#" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def stamp(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_only_touched_years_are_written(spark, tmp_path):
    path, schema = str(tmp_path / "stored"), "incident_id long, occurred_at timestamp_ntz, v int"
    rows = [(i, datetime(1995 + i % 5, 1, 1 + i % 20), i) for i in range(100)] + [(200, None, 1), (300, datetime(2010, 1, 1), 1)]
    old = spark.createDataFrame(rows, schema)
    # 1996 has an altered row, 1997 sends one to 1998, 2010 and the rows without a date lose all, 2011 is new.
    moved = {i: (i, d, v) for i, d, v in rows if i not in (200, 300)}
    moved[1] = (1, rows[1][1], -1)
    moved[2] = (2, datetime(1998, 6, 6), 2)
    moved[400] = (400, datetime(2011, 1, 1), 4)
    new = spark.createDataFrame(list(moved.values()), schema)
    write_incidents_parquet(old, path)
    before = stamp(path)
    found = change_set(old, new, ["incident_id"])
    assert update_incidents_parquet(old, new, found, path) == [1996, 1997, 1998, 2010, 2011, None]
    after = stamp(path)
    untouched = [f for f in before if "year=1995" in f or "year=1999" in f]
    assert untouched and all(after[f] == before[f] for f in untouched)
    assert not any("2010" in f or "HIVE_DEFAULT" in f for f in after)
    got = sorted(map(tuple, spark.read.parquet(path).select("incident_id", "occurred_at", "v").collect()))
    assert got == sorted(moved.values())
    assert update_incidents_parquet(new, new, change_set(new, new, ["incident_id"]), path) == []
    assert update_incidents_parquet(old, new, found, path) and stamp(path).keys() & set(untouched) == set(untouched)  # once more
    assert sorted(map(tuple, spark.read.parquet(path).select("incident_id", "occurred_at", "v").collect())) == got
