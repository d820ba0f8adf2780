"""Arithmetic that survives NULL and zero, histogram buckets and great-circle distance."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MI = 3961
KM_PER_MI = 1.60934


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def _fold(op: Callable, cols: Sequence[Column]) -> Column:
    if isinstance(cols, (str, dict, Column)):
        raise TypeError("give the columns as one list")
    return reduce(op, [F.coalesce(c, F.lit(0)) for c in cols])


def safe_add(cols: Sequence[Column]) -> Column:
    """Sum that reads NULL as zero."""
    return _fold(add, cols)


def safe_subtract(cols: Sequence[Column]) -> Column:
    """First column less all later ones, NULL read as zero."""
    return _fold(sub, cols)


def width_bucket(value: Column, low, high, buckets: int, compat: bool = False) -> Column:
    """Equal-width bucket 1..n of ``value``; 0 below ``low`` and n+1 from ``high`` on.

    ``compat`` counts as a formula does that some databases use: buckets end with their upper edge and one is added
    where the value itself, not its distance from ``low``, is a multiple of the width, above the last bucket too.
    """
    low, high = (b if isinstance(b, Column) else F.lit(float(b)) for b in (low, high))
    if compat:
        width = (high - low).cast("double") / buckets
        place = (value.cast("double") - low) / width
        edge = F.when(value.cast("double") % width == 0, F.lit(1)).otherwise(F.lit(0))
        return (F.least(F.ceil(place).cast("int"), F.lit(buckets + 1)) + edge).cast("int")
    return F.width_bucket(value.cast("double"), low.cast("double"), high.cast("double"), F.lit(buckets))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance between two coordinates given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")

    def half_chord(a: Column, b: Column) -> Column:
        s = F.sin(F.radians(b - a) / 2)
        return s * s

    h = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    miles = F.asin(F.least(F.sqrt(h), F.lit(1.0))) * (2 * EARTH_RADIUS_MI)
    return miles if unit == "mi" else miles * KM_PER_MI


def with_distance(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str,
                  unit: str = "mi", name: str = "distance") -> DataFrame:
    """Add the distance between the two coordinate pairs of every row."""
    return df.withColumn(name, haversine(*map(F.col, (lat1, lon1, lat2, lon2)), unit=unit))
