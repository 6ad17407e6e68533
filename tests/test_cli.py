"""The command line runs a question on files and writes its result."""

from conftest import DATA
from test_sources import _two_periods

from beatline.__main__ import main
from beatline.plans import queries as Q
from beatline.sources import read_incidents_csv, read_stations_csv


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cli_writes_results(spark, tmp_path):
    p1, p2, h1, _ = _two_periods(tmp_path)
    st = f"{DATA}/stations_sample.csv"
    inc = read_incidents_csv(spark, [p1, p2])
    out = str(tmp_path / "o1")
    main(["nearest-division", "--incidents", p1, p2, "--stations", st, "--out", out], spark)
    assert _rows(spark.read.parquet(out)) == _rows(Q.nearest_division_stats(inc, read_stations_csv(spark, st)))
    out2 = str(tmp_path / "o2")
    main(["day-segments-lines", "--incidents", p1, p2, "--out", out2], spark)
    assert _rows(spark.read.parquet(out2)) == [("Afternoon", 1)]
    df = main(["top-months", "--sql", "--incidents", p1, p2, "--show", "5"], spark)
    assert _rows(df) == _rows(Q.top_months_by_count(inc))


def test_convert_then_query_parquet(spark, tmp_path):
    p1, p2, _, _ = _two_periods(tmp_path)
    pq = str(tmp_path / "pq")
    main(["convert", "--incidents", p1, p2, "--out", pq], spark)
    t = spark.read.parquet(pq)
    assert "occurred_year" in t.columns and t.count() == 3
    from beatline.operators import in_year
    sel = in_year(t, "occurred_at", 2015)
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "occurred_year" in plan
    assert sorted(r.incident_id for r in sel.collect()) == [1, 2]
    df = main(["top-months", "--incidents-format", "parquet", "--incidents", pq, "--show", "3"], spark)
    assert _rows(df) == _rows(Q.top_months_by_count(read_incidents_csv(spark, [p1, p2])))


def test_conversion_never_hashes_a_year_into_one_task(spark, tmp_path):
    from beatline.sources.csv import year_partitioned
    p1, p2, _, _ = _two_periods(tmp_path)
    plan = year_partitioned(read_incidents_csv(spark, [p1, p2]))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(occurred_at" in plan.lower()
    assert "hashpartitioning(occurred_year" not in plan.lower()
