"""Streaming counts equal the batch counts after each batch of new files."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from beatline.plans import queries as Q
from beatline.sources import standins as S
from beatline.streaming import (
    day_segment_counts_stream, incident_stream, monthly_counts_stream, run_available, top_months_sink,
)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_counts_follow_new_files(spark, tmp_path):
    inc = S.core(S.incidents(spark, SF_SMALL))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    src, ck1, ck2 = str(tmp_path / "in"), str(tmp_path / "ck1"), str(tmp_path / "ck2")
    out1, out2 = str(tmp_path / "seg"), str(tmp_path / "top")
    inc.filter(F.col("occurred_at") < cut).write.mode("append").parquet(src)

    def run():
        stream = incident_stream(spark, src, inc.schema)
        run_available(day_segment_counts_stream(stream), out1, ck1)
        run_available(monthly_counts_stream(stream), out2, ck2, writer=top_months_sink(out2))

    run()
    first = inc.filter(F.col("occurred_at") < cut)
    assert _rows(spark.read.parquet(out1)) == _rows(Q.day_segment_counts(first))
    inc.filter(~F.coalesce(F.col("occurred_at") < cut, F.lit(False))).write.mode("append").parquet(src)
    run()
    assert _rows(spark.read.parquet(out1)) == _rows(Q.day_segment_counts(inc))
    assert _rows(spark.read.parquet(out2)) == _rows(Q.top_months_by_count(inc))


def test_windows_close_once(spark, tmp_path):
    """A repeat within the watermark counts once, a late row is counted apart, an open window is not written."""
    from datetime import datetime

    from beatline.streaming import late_counts, run_closed, run_late, windowed_counts_stream

    def day(d, h=0):
        return datetime(2000, 1, d, h)

    batches = [[(1, day(1)), (1, day(1)), (2, day(1, 23)), (3, day(2)), (9, None)],
               [(2, day(1, 23)), (4, day(3)), (5, day(6, 5))],  # 2 again while its day is open; 4's day is open
               [(6, day(1, 1)), (6, day(1, 1)), (7, day(6, 23)), (8, day(9))]]  # 6 comes too late, twice
    src = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, "id int, at timestamp_ntz").write.mode("append").parquet(src)
        events = incident_stream(spark, src, spark.read.parquet(src).schema)
        run_closed(windowed_counts_stream(events, "at", "1 day", late="2 days", event_id="id"), str(tmp_path / "out"), str(tmp_path / "a"))
        run_late(events, str(tmp_path / "l"), str(tmp_path / "b"), "at", "1 day", "2 days", event_id="id")
    got = [(r.start_at, r.end_at, r.crime_count) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("start_at").collect()]
    assert got == [(day(1), day(2), 2), (day(2), day(3), 1), (day(3), day(4), 1), (day(6), day(7), 2)]  # day 9 is open
    assert [(r.start_at, r.crime_count) for r in late_counts(str(tmp_path / "l"), spark).collect()] == [(day(1), 1)]
