"""Number series and date spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.dates import boundaries, shift


def number_series(spark: SparkSession, upper: int, name: str = "generated_number") -> DataFrame:
    """1, 2, ... upper."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).toDF(name)


def date_spine(spark: SparkSession, part: str, start: dt.date, end: dt.date) -> DataFrame:
    """Column ``date_<part>``: start, start + 1 part, ... with the end left out.

    Dates stay dates; date-times give timestamps.
    """
    periods = boundaries(start, end, part)
    if periods <= 0:
        raise ValueError("the spine must end after it starts")
    day_only = not isinstance(start, dt.datetime) and part.lower() not in ("second", "minute", "hour")
    first = F.lit(start).cast("timestamp_ntz")
    moment = shift(first, part, F.col("id"))
    spine = spark.range(periods).select(moment.alias(f"date_{part}"))
    spine = spine.filter(F.col(f"date_{part}") <= F.lit(end).cast("timestamp_ntz"))
    return spine.select(F.col(f"date_{part}").cast("date")) if day_only else spine
