"""Shaping of plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that are computed once a row: filters on them stay above, instead of being pushed into, and so
    repeated in, all that they are made of."""
    held = F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("#once")
    return df.select(*(c for c in df.columns if c not in columns), held).select("*", "#once.*").drop("#once")
