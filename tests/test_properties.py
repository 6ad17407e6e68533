"""Property tests: column functions against plain-Python statements of the rules."""

import bisect

from hypothesis import given, settings
from hypothesis import strategies as st

from beatline.functions import day_segment, label_of, parse_money
from beatline.functions.text import DESCENT_LABELS


# Minute of the clock (HHMM) from which a label holds, up to the next entry.
SEGMENTS = [(-10**9, "Undefined"), (0, "Night"), (459, "Undefined"), (500, "Morning"), (1159, "Undefined"),
            (1200, "Afternoon"), (1659, "Undefined"), (1700, "Evening"), (2059, "Undefined"), (2100, "Night"),
            (2360, "Undefined")]


def expected_segment(t):
    return "Undefined" if t is None else SEGMENTS[bisect.bisect_right(SEGMENTS, (t, "~")) - 1][1]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 2500)), min_size=1, max_size=200))
def test_day_segment_rule(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "t int")
    got = [r[0] for r in df.select(day_segment("t")).collect()]
    assert got == [expected_segment(t) for t in times]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 10_000_000), min_size=1, max_size=100))
def test_money_round_trip(spark, amounts):
    df = spark.createDataFrame([(f"${a:,}",) for a in amounts], "s string")
    got = [r[0] for r in df.select(parse_money("s", to="double")).collect()]
    assert got == [float(a) for a in amounts]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ", max_size=2)),
                min_size=1, max_size=100))
def test_labels_rule(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r[0] for r in df.select(label_of("c")).collect()]
    assert got == [DESCENT_LABELS.get(c, "Unknown") for c in codes]


coord = st.integers(0, 63)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(coord, coord), min_size=1, max_size=30),
       st.lists(st.tuples(st.one_of(st.none(), coord), coord), min_size=1, max_size=30))
def test_nearest_equals_brute_force(spark, stations, points):
    """Nearest station on a 1/64° grid (many exact ties) equals a Python scan
    in key order with a strict '<', i.e. the lowest key wins a tie."""
    from test_operators import _close, _hav

    from beatline.operators import nearest_station

    st_rows = [(i + 1, f"D{i}", 34 + y / 64, -118 + x / 64) for i, (y, x) in enumerate(stations)]
    f_rows = [(i, None if y is None else 34 + y / 64, -118 + x / 64) for i, (y, x) in enumerate(points)]
    got = {r.id: r.n for r in nearest_station(
        spark.createDataFrame(f_rows, "id int, lat double, lon double"),
        spark.createDataFrame(st_rows, "fid int, division string, y double, x double"), out="n").collect()}
    for i, la, lo in f_rows:
        if la is None:
            assert got[i] is None
            continue
        dist, fid = min((round(_hav(la, lo, y, x), 6), fid) for fid, _, y, x in st_rows)
        assert got[i].key == fid and _close(got[i].dist, dist)
