"""CSV and line readers on small hand-written files."""

import datetime as dt

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from beatline.plans import queries as Q
from beatline.schemas import INCIDENT_HEADER
from beatline.sources import (
    drop_header, first_line, parse_incident_lines, read_csv_inferred, read_geocodes_csv,
    read_incidents_csv, read_incomes_csv, read_lines, read_stations_csv, union_periods,
)


def _incident_line(dr, date, time, area, name, premises, weapon, lat, lon, desc="THEFT", descent="H"):
    f = [""] * 28
    f[0], f[1], f[2], f[3], f[4], f[5] = str(dr), date, date, str(time), str(area), name
    f[9], f[13], f[15], f[16], f[26], f[27] = desc, descent, premises, weapon, lat, lon
    return ",".join(f)


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def _two_periods(tmp_path):
    h1 = ",".join(INCIDENT_HEADER)
    h2 = ",".join(h.strip() for h in INCIDENT_HEADER)
    p1 = _write(tmp_path / "a.csv", [
        h1,
        _incident_line(1, "03/01/2015 12:00:00 AM", 1200, 5, "Harbor", "STREET", "102", "33.75", "-118.28"),
        _incident_line(2, "03/02/2015 11:59:00 PM", 459, 5, "Harbor", '"STREET, SIDE"', "", "0", "0",
                       desc='"THEFT, PETTY"'),
    ])
    p2 = _write(tmp_path / "b.csv", [
        h2,
        _incident_line(3, "bad date", 2100, 18, "Southeast", "PARKING LOT", "400", "33.9", "-118.2", descent=""),
    ])
    return p1, p2, h1, h2


def test_incident_csv_two_periods(spark, tmp_path):
    p1, p2, _, _ = _two_periods(tmp_path)
    df = read_incidents_csv(spark, [p1, p2])
    rows = {r.incident_id: r for r in df.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].occurred_at == dt.datetime(2015, 3, 1) and rows[1].reported_on == dt.date(2015, 3, 1)
    assert rows[1].area_id == 5 and rows[1].weapon_code == 102 and rows[1].lat == 33.75
    assert rows[2].premises == "STREET, SIDE" and rows[2].crime_desc == "THEFT, PETTY"
    assert rows[2].weapon_code is None and rows[2].time_hhmm == 459
    assert rows[3].occurred_at is None and rows[3].category is None


def test_inferred_look_at_a_file(spark, tmp_path):
    p1, _, _, _ = _two_periods(tmp_path)
    assert dict(read_csv_inferred(spark, p1).dtypes)["LAT"] == "double"


def test_columns_are_found_by_header(spark, tmp_path):
    """Another order, blanks and a byte order mark around the names, columns the package doesn't know."""
    p = _write(tmp_path / "st.csv", ["\ufeffFID, X ,Y,Extra,DIVISION,PREC,LOCATION", "1,-118.2,34.0,?,HARBOR,5,A ST"])
    row = read_stations_csv(spark, p).first()
    assert (row.fid, row.x, row.y, row.division, row.prec) == (1, -118.2, 34.0, "HARBOR", 5)
    with pytest.raises(ValueError, match="PREC"):
        read_stations_csv(spark, _write(tmp_path / "bad.csv", ["X,Y,FID,DIVISION,LOCATION", "1,2,3,A,B"]))


def test_files_of_a_folder_must_share_a_header(spark, tmp_path):
    folder = tmp_path / "st"
    folder.mkdir()
    _write(folder / "a.csv", ["LAT,LON,ZIPcode", "1,2,90001"])
    _write(folder / "b.csv", ["LON,LAT,ZIPcode", "1,2,90001"])
    with pytest.raises(Exception, match="header"):
        read_geocodes_csv(spark, str(folder)).collect()


def test_doubled_quotes_and_bad_numbers(spark, tmp_path):
    p = _write(tmp_path / "inc.csv", ["Zip Code,Community,Estimated Median Income",
                                      '90001,"The ""Old"" Town, East","$1,234"', "9O002,West,---"])
    rows = {r.community: r for r in read_incomes_csv(spark, p).collect()}
    assert rows['The "Old" Town, East'].income_text == "$1,234" and rows["West"].zip is None
    from beatline.schemas import INCOME_HEADER, INCOME_SCHEMA
    from beatline.sources import parse_csv_lines, read_by_header
    bad = read_by_header(spark, p, INCOME_HEADER, INCOME_SCHEMA, bad_fields="bad").collect()
    assert sorted(r.bad for r in bad) == [[], ["zip"]]
    line = spark.createDataFrame([('90001,"The ""Old"" Town, East","$1,234"',)], "value string")
    assert parse_csv_lines(line, INCOME_SCHEMA).first().community == 'The "Old" Town, East'


def test_geocodes_file(spark, tmp_path):
    p = _write(tmp_path / "geo.csv", ["LAT,LON,ZIPcode", '33.75,-118.28,"90731,90744"', "34.0,-118.2,90001"])
    assert sorted(tuple(r) for r in read_geocodes_csv(spark, p).collect()) == [
        (33.75, -118.28, "90731,90744"), (34.0, -118.2, "90001")]


def test_rows_without_a_date_survive_every_reader(spark, tmp_path):
    """100 orders, 10 of them undated: all 100 pass the two period files, and a rewritten source
    gives the new rows."""
    from beatline.plans.catalog import QUERIES
    for n in (100, 300):
        spark.range(n).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"),
            F.when(F.col("id") % 10 != 3, F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")).alias("o_orderdate"),
        ).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
        for key in ("all_incidents", "scan_incidents_csv", "typed_incidents", "scan_lines", "day_segments"):
            assert QUERIES[key](spark, str(tmp_path)).count() == n, key
        assert QUERIES["incident_row_count"](spark, str(tmp_path)).first()[0] == n
        assert QUERIES["typed_incidents"](spark, str(tmp_path)).where("occurred_at IS NULL").count() >= n // 10
        assert sum(r.crime_count for r in QUERIES["day_segment_counts_lines"](spark, str(tmp_path)).collect()) > 0


def test_lines_keep_naive_split(spark, tmp_path):
    p1, p2, h1, h2 = _two_periods(tmp_path)
    lines = read_lines(spark, [p1, p2])
    assert first_line(spark, p1) == h1
    assert drop_header(lines, h1).count() == 4        # 3 rows + the second header
    seg = {r.day_segment: r.crime_count for r in Q.day_segment_counts_lines(lines, h1).collect()}
    # row 2's quoted comma in field 9 shifts premises out of field 15
    assert seg == {"Afternoon": 1}
    typed = read_incidents_csv(spark, [p1, p2])
    seg2 = {r.day_segment: r.crime_count for r in Q.day_segment_counts(typed).collect()}
    assert seg2 == {"Afternoon": 1, "Undefined": 1}


def test_parse_lines_matches_file_reader(spark, tmp_path):
    p1, p2, h1, h2 = _two_periods(tmp_path)
    body = drop_header(drop_header(read_lines(spark, [p1, p2]), h1), h2)
    a = sorted(tuple(r) for r in parse_incident_lines(body).select("incident_id", "occurred_at", "premises", "lat").collect())
    b = sorted(tuple(r) for r in read_incidents_csv(spark, [p1, p2]).select("incident_id", "occurred_at", "premises", "lat").collect())
    assert a == b


def test_stations_with_bom(spark):
    st = read_stations_csv(spark, f"{DATA}/stations_sample.csv").orderBy("fid").collect()
    assert [r.division for r in st] == ["HARBOR", "SOUTHEAST", "77TH STREET"]
    assert st[0].x == -118.289241553 and st[0].prec == 5
    got = read_stations_csv(spark, f"{DATA}/stations_sample.csv").select(F.initcap("division")).collect()
    assert "77th Street" in [r[0] for r in got]


def test_incomes_quoted_commas(spark):
    inc = read_incomes_csv(spark, f"{DATA}/income_2015_sample.csv")
    rows = {r.zip: r for r in inc.collect()}
    assert rows[90001].community == "Los Angeles (South Los Angeles), Florence-Graham"
    assert rows[90272].income_text == "$166,021"


def test_lines_equal_typed_counts_without_commas(spark, tmp_path):
    h1 = ",".join(INCIDENT_HEADER)
    rows = [_incident_line(i, "03/01/2015 12:00:00 AM", t, 5, "Harbor", p, "102", "33.75", "-118.28")
            for i, (t, p) in enumerate([(600, "STREET"), (1300, "STREET"), (2200, "SIDEWALK"),
                                        (2200, "ALLEY STREET"), (459, "STREET")])]
    p1 = _write(tmp_path / "c.csv", [h1] + rows)
    a = {r.day_segment: r.crime_count for r in Q.day_segment_counts_lines(read_lines(spark, p1), h1).collect()}
    b = {r.day_segment: r.crime_count for r in Q.day_segment_counts(read_incidents_csv(spark, p1)).collect()}
    assert a == b == {"Morning": 1, "Afternoon": 1, "Night": 1, "Undefined": 1}


def test_first_line_of_empty_file_and_positional_union(spark, tmp_path):
    empty = tmp_path / "empty.txt"
    empty.write_text("")
    assert first_line(spark, str(empty)) is None
    full = _write(tmp_path / "full.txt", ["h", "a", "b"])
    assert first_line(spark, [str(empty), full]) == "h"
    lines = read_lines(spark, [str(empty), full])
    assert sorted(r[0] for r in drop_header(lines, first_line(spark, [str(empty), full])).collect()) == ["a", "b"]
    assert drop_header(lines, first_line(spark, str(empty))).count() == 3
    a = spark.createDataFrame([(1, "x")], "area_id int, area_name string")
    b = spark.createDataFrame([("y", 2)], "area_name string, area_id int")
    by_name = sorted(tuple(r) for r in union_periods(a, b).collect())
    assert by_name == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3, "z")], "AREA int, name string")
    positional = union_periods(a, c, by_name=False)
    assert positional.columns == ["area_id", "area_name"]
    assert sorted(tuple(r) for r in positional.collect()) == [(1, "x"), (3, "z")]
