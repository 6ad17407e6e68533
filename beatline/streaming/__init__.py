"""The counting questions over a growing folder of incident files."""

from beatline.streaming.incremental import (
    day_segment_counts_stream, incident_stream, monthly_counts_stream, run_available,
    top_months_sink,
)

from beatline.streaming.windows import late_counts, run_closed, run_late, windowed_counts_stream

__all__ = ["late_counts", "run_closed", "run_late", "windowed_counts_stream", "day_segment_counts_stream", "incident_stream", "monthly_counts_stream",
           "run_available", "top_months_sink"]
