"""Column functions: everything is a built-in Spark expression."""

from beatline.functions.geo import EARTH_RADIUS_KM, haversine_km
from beatline.functions.text import (
    DESCENT_LABELS, field, first_list_item, label_of,
    parse_money, thousands, to_int,
)
from beatline.functions.time import (
    DAY_SEGMENTS, OCCURRED_PATTERN, day_segment, parse_date,
    parse_timestamp, year_range,
)

__all__ = [
    "EARTH_RADIUS_KM", "haversine_km", "DESCENT_LABELS", "field", "first_list_item", "label_of", "parse_money", "thousands", "to_int",
    "DAY_SEGMENTS", "OCCURRED_PATTERN", "day_segment", "parse_date",
    "parse_timestamp", "year_range",
]
