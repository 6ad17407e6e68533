"""The counting questions over a growing incident folder (Structured Streaming).

New files dropped into the folder are read incrementally; Spark keeps the
running counts in its state store, checkpointed to a shared folder, so a run
resumes after a failure or a restart without recounting old files. The
state is one row per group (months or day segments), not per incident.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from beatline.functions.time import day_segment
from beatline.operators.relational import containing, count_by, rank_within
from beatline.plans.queries import STREET_TEXT, TOP_MONTHS


def incident_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming DataFrame over the files of ``path`` (declared schema, no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def monthly_counts_stream(incidents: DataFrame, ts: str = "occurred_at") -> DataFrame:
    """Running incident count per (year, month)."""
    dated = incidents.filter(F.col(ts).isNotNull())
    return count_by(dated, [F.year(ts).alias("year"), F.month(ts).alias("month")])


def day_segment_counts_stream(incidents: DataFrame, premises_text: str = STREET_TEXT) -> DataFrame:
    """Running count of street incidents per part of day."""
    street = containing(incidents, "premises", premises_text)
    return count_by(street, [day_segment("time_hhmm").alias("day_segment")])


def _overwrite(path: str, transform=None):
    def write(batch: DataFrame, _epoch: int) -> None:
        out = batch if transform is None else transform(batch)
        out.write.mode("overwrite").parquet(path)
    return write


def top_months_sink(path: str, top: int = TOP_MONTHS):
    """``foreachBatch`` writer: rank the complete monthly counts of each
    trigger and overwrite ``path`` with the top months of every year."""
    def transform(counts: DataFrame) -> DataFrame:
        ranked = rank_within(counts, ["year"], "crime_count", "rank", top)
        return ranked.select("year", "month", "crime_count", "rank")
    return _overwrite(path, transform)


def run_available(counts: DataFrame, out_path: str, checkpoint: str, writer=None) -> StreamingQuery:
    """Process every file present now, then stop (``availableNow``); the
    complete result table is written to ``out_path`` after each trigger.

    ``checkpoint`` must be on the shared file system on a cluster.
    """
    q = (counts.writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(writer or _overwrite(out_path))
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
