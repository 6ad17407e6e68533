"""Text, number and label column functions (JVM expressions, no UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from beatline.functions._util import as_col

# --- fixed values: characters stripped from a money text before the cast.
MONEY_NOISE = r"[$,]"

# --- fixed values: victim descent code → label; any other code → Unknown.
DESCENT_LABELS = {
    "A": "Other Asian", "B": "Black", "C": "Chinese", "D": "Cambodian",
    "F": "Filipino", "G": "Guamanian", "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native", "J": "Japanese", "K": "Korean",
    "L": "Laotian", "O": "Other", "P": "Pacific Islander", "S": "Samoan",
    "U": "Hawaiian", "V": "Vietnamese", "W": "White", "X": "Unknown",
    "Z": "Asian Indian",
}
UNKNOWN_LABEL = "Unknown"


def parse_money(text, to: str = "float") -> Column:
    """``'$1,234'`` → 1234.0; text that is not a number (``---``) → NULL."""
    return F.regexp_replace(as_col(text), MONEY_NOISE, "").try_cast(to)


def first_list_item(text, sep: str = ",") -> Column:
    """First item of a separated list (``'90001,90002'`` → ``'90001'``)."""
    return F.split(as_col(text), sep).getItem(0)


def to_int(text) -> Column:
    """Text → int, NULL when not an integer (never raises under ANSI)."""
    return as_col(text).try_cast("int")


def label_of(code, labels: dict[str, str] | None = None, default: str = UNKNOWN_LABEL) -> Column:
    """Map a code through a literal map; unmapped codes → ``default``."""
    labels = DESCENT_LABELS if labels is None else labels
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in labels.items()))
    return F.coalesce(F.try_element_at(m, as_col(code)), F.lit(default))


def thousands(x, decimals: int = 3) -> Column:
    """Number → text with thousands commas and fixed decimals (``1,234.500``)."""
    return F.format_number(as_col(x), decimals)


def field(line, pos: int, sep: str = ",") -> Column:
    """Field ``pos`` (0-based) of a line split on every ``sep``; NULL when short.

    This is a plain split: quoted separators are *not* honoured, as in a
    line-oriented reader.
    """
    return F.get(F.split(as_col(line), sep), pos)
