"""DataFrame → DataFrame operators."""

from beatline.operators.changes import change_set, row_digest, touched_values
from beatline.operators.frames import rolling_counts, sessions
from beatline.operators.joins import estimated_bytes, join_dim, with_strategy
from beatline.operators.levels import cube_sets, grouping_levels, rollup_sets
from beatline.operators.near import counts_within
from beatline.operators.nearest import nearest_distance, nearest_of_places, nearest_station
from beatline.operators.profile import profile
from beatline.operators.relational import (
    code_between, containing, count_by, in_year, mean_and_count, mean_of_counted, not_null,
    rank_within, row_count, sort_by_count, top_and_bottom, top_k,
)
from beatline.operators.sketches import estimates, merged, summaries
from beatline.operators.temporal import as_of_join, in_periods, overlapping
from beatline.operators.udf import with_udf

__all__ = [
    "estimated_bytes", "join_dim", "with_strategy", "nearest_distance",
    "nearest_of_places", "nearest_station", "profile", "code_between", "containing", "count_by", "in_year",
    "mean_and_count", "mean_of_counted", "not_null", "rank_within", "row_count", "sort_by_count",
    "top_and_bottom", "top_k", "with_udf", "as_of_join", "in_periods", "overlapping",
    "rolling_counts", "sessions", "change_set", "row_digest", "touched_values", "cube_sets", "grouping_levels",
    "rollup_sets", "counts_within", "estimates", "merged", "summaries",
]
