"""Vector arithmetic on array columns, in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.text import bind


def _doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalize(v: Column) -> Column:
    """To unit length; a zero vector stays."""
    return bind(norm(v), lambda n: F.when(n == 0, _doubles(v)).otherwise(F.transform(_doubles(v), lambda x: x / n)))
