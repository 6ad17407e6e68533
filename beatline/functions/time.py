"""Date, time and time-of-day column functions (JVM expressions, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from beatline.functions._util import as_col

# --- fixed values: the published text form of the incident dates.
OCCURRED_PATTERN = "MM/dd/yyyy hh:mm:ss a"

# --- fixed values: day segments over an HHMM integer, in the order tested.
# (label, [(low inclusive, high exclusive), ...]); anything else is Undefined.
# The one-minute gaps at 459-499, 1159, 1659, 2059 are intentional.
DAY_SEGMENTS = (
    ("Morning", ((500, 1159),)),
    ("Afternoon", ((1200, 1659),)),
    ("Evening", ((1700, 2059),)),
    ("Night", ((2100, 2360), (0, 459))),
)
UNDEFINED_SEGMENT = "Undefined"


def parse_timestamp(text, pattern: str = OCCURRED_PATTERN) -> Column:
    """Text → ``timestamp_ntz`` by pattern; unparseable or NULL text → NULL.

    ``try_to_timestamp`` guards the strict NTZ parse, so ANSI mode never
    raises and the wall-clock value does not depend on the session zone.
    """
    c = as_col(text)
    fmt = F.lit(pattern)
    return F.when(F.try_to_timestamp(c, fmt).isNotNull(), F.to_timestamp_ntz(c, fmt))


def parse_date(text, pattern: str = OCCURRED_PATTERN) -> Column:
    """Text → ``date`` by pattern (time part dropped); bad text → NULL."""
    return F.try_to_date(as_col(text), pattern)


def day_segment(time_hhmm) -> Column:
    """Part-of-day label for an HHMM integer; NULL and gaps → Undefined."""
    t = as_col(time_hhmm)
    expr = None
    for label, ranges in DAY_SEGMENTS:
        cond = None
        for lo, hi in ranges:
            piece = (t >= lo) & (t < hi)
            cond = piece if cond is None else (cond | piece)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(UNDEFINED_SEGMENT)


def year_range(ts, year: int) -> Column:
    """``year(ts) == year`` written as a range so Parquet can push both bounds.

    Works for date, timestamp and timestamp_ntz columns: the literal bounds
    are cast to the column's type by the analyzer.
    """
    c = as_col(ts)
    # Bounds from text, so neither the Python nor the session time zone moves them.
    lo = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (c >= lo) & (c < hi)


def pattern_text(ts) -> Column:
    """A ``timestamp_ntz`` as ``MM/dd/yyyy hh:mm:ss a`` text, built from its
    fields so no time zone (and no daylight-saving gap) is involved."""
    c = as_col(ts)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    h12 = F.when(F.hour(c) % 12 == 0, 12).otherwise(F.hour(c) % 12)
    return F.concat(two(F.month(c)), F.lit("/"), two(F.dayofmonth(c)), F.lit("/"),
                    F.lpad(F.year(c).cast("string"), 4, "0"), F.lit(" "), two(h12), F.lit(":"),
                    two(F.minute(c)), F.lit(":"), two(F.second(c)), F.lit(" "),
                    F.when(F.hour(c) < 12, "AM").otherwise("PM"))
