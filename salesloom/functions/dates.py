"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom.functions.text import strip


def parse_day_first(text: Column) -> Column:
    """Read d/M/yyyy, also written with ``-`` or ``.``; anything else is NULL."""
    return F.try_to_date(F.translate(strip(text), "-.", "//"), "d/M/yyyy")


def calendar_columns(day: Column) -> list[Column]:
    """Calendar parts: ISO week, full English names, weekend = Saturday or Sunday."""
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(1, 7).cast("int").alias("is_weekend"),
    ]
