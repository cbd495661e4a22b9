"""Dense vectors held as ARRAY<DOUBLE>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(left: Column, right: Column) -> Column:
    """Squared Euclidean distance of two arrays of equal length."""
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)
