"""Counts by event time over a growing folder: windows that close, repeats and late rows.

A watermark follows the latest event time seen, ``late`` behind. Windows that end before it are
written out once and leave the state, so the state holds the open windows and the ids of the rows
of the last ``late`` stretch, however long the stream runs. A row that arrives again within that
stretch is dropped; a row that is older than the watermark when it arrives is left out
of the counts, and :func:`late_counts_sink` counts such rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType


def _windowed(rows: DataFrame, at: str, size: str, slide: str | None, keys: tuple[str, ...]) -> DataFrame:
    span = F.window(at, size, slide) if slide else F.window(at, size)
    return rows.groupBy(span.alias("span"), *keys).agg(F.count(F.lit(1)).alias("crime_count")).select(
        F.col("span.start").alias("start_at"), F.col("span.end").alias("end_at"), *keys, "crime_count")


def windowed_counts_stream(events: DataFrame, at: str, size: str, *, slide: str | None = None, late: str = "7 days",
                           keys: tuple[str, ...] = (), event_id: str | None = None) -> DataFrame:
    """Rows by window of ``size`` (tumbling, or sliding by ``slide``) and ``keys``, for append mode. With ``event_id``
    a row whose id came within the watermark before counts once. Rows without a time count nowhere."""
    local = isinstance(events.schema[at].dataType, TimestampNTZType)
    rows = events.where(F.col(at).isNotNull())
    if local:  # a watermark needs moments: wall-clock times count as UTC, whatever the session's zone
        rows = rows.withColumn(at, F.make_timestamp(
            F.year(at), F.month(at), F.day(at), F.hour(at), F.minute(at), F.expr(f"extract(SECOND FROM `{at}`)"), F.lit("UTC")))
    rows = rows.withWatermark(at, late)
    if event_id:
        rows = rows.dropDuplicatesWithinWatermark([event_id])
    counts = _windowed(rows, at, size, slide, keys)
    if local:
        counts = counts.withColumns({c: F.expr(
            f"timestampadd(SECOND, unix_seconds({c}), TIMESTAMP_NTZ'1970-01-01 00:00:00')") for c in ("start_at", "end_at")})
    return counts


def run_closed(counts: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Process every file present now, append the windows that closed to ``out_path``, then stop."""
    q = (counts.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _behind(top: Column, late: str) -> Column:
    return top - F.expr(f"INTERVAL {late}")


def late_counts_sink(path: str, at: str, size: str, late: str = "7 days", event_id: str | None = None):
    """``foreachBatch`` writer: the rows of each batch that are older than the watermark of the batches before
    (each ``event_id`` once), counted by window below ``path``/late; a batch that is done again writes the same files."""
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        dated = batch.where(F.col(at).isNotNull())
        dated.agg(F.max(at).alias("top")).write.mode("overwrite").parquet(f"{path}/seen/epoch={epoch}")
        top = spark.read.parquet(f"{path}/seen").where(F.col("epoch") < epoch).agg(F.max("top")).scalar()
        found = dated.where(F.col(at) < _behind(top, late))
        if event_id:
            found = found.dropDuplicates([event_id])
        _windowed(found, at, size, None, ()).write.mode("overwrite").parquet(f"{path}/late/epoch={epoch}")
    return write


def run_late(events: DataFrame, path: str, checkpoint: str, at: str, size: str, late: str = "7 days",
             event_id: str | None = None) -> StreamingQuery:
    """Count the late rows of every file present now, then stop."""
    q = (events.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(late_counts_sink(path, at, size, late, event_id)).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def late_counts(events_path: str, spark) -> DataFrame:
    """What :func:`late_counts_sink` has counted, over all batches."""
    return spark.read.parquet(f"{events_path}/late").groupBy("start_at", "end_at").agg(
        F.sum("crime_count").alias("crime_count"))
