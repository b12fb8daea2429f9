"""Date expressions; today is always given, so that runs can be repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_since(text: Column, today: Column) -> Column:
    """Whole months from a date written YYYY-MM or YYYY-MM-DD; null if it cannot be read."""
    year, month = F.substring(text, 1, 4).try_cast("int"), F.substring(text, 6, 2).try_cast("int")
    return (F.year(today) - year) * 12 + F.month(today) - month


def recency(text: Column, today: Column) -> Column:
    """1 within a year, 0.5 within two, else 0."""
    months = months_since(text, today)
    return F.when(months <= 12, 1.0).when(months <= 24, 0.5).otherwise(0.0)


def iso_date(us_date: Column) -> Column:
    """MM/DD/YYYY as YYYY-MM-DD; null if it is none."""
    return F.date_format(F.try_to_date(us_date, "M/d/yyyy"), "yyyy-MM-dd")
