"""Rounding as the queries' SQL does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column | str, places: int) -> Column:
    """A double to ``places`` places: the product with a power of ten, halves away from zero. What rounds to zero from below is -0.0; Spark's
    round goes by the shortest decimal of the number instead, and has no negative zero."""
    scale = 10.0**places
    return F.signum(c) * F.round(F.abs(c) * F.lit(scale), 0) / F.lit(scale)
