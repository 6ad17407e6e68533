"""Great-circle distance as a column expression (runs inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from beatline.functions._util import as_col

# --- fixed values: mean Earth radius in kilometres used for all distances.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km between two (lat, lon) points in degrees.

    NULL when any coordinate is NULL or NaN. Rounding can push the intermediate
    term of antipodes past 1; it counts as 1.
    """
    la1, lo1, la2, lo2 = (as_col(c) for c in (lat1, lon1, lat2, lon2))
    half_dlat = F.radians(la2 - la1) / 2
    half_dlon = F.radians(lo2 - lo1) / 2
    a = (F.sin(half_dlat) * F.sin(half_dlat)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.sin(half_dlon) * F.sin(half_dlon))
    a = F.when((a > 1) & ~F.isnan(a), 1.0).otherwise(a)
    d = F.lit(EARTH_RADIUS_KM) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))
    return F.nanvl(d, F.lit(None).cast("double"))
