"""Operators over keyed, append-only tables: latest rows, inserts, upserts, fingerprints, tops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in the order given (which should be total)."""
    return first_rows(df, keys, 1, *order).drop("#n")


def first_rows(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows per key, numbered in #n; Catalyst limits each group before it shuffles."""
    return df.withColumn("#n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("#n") <= n)


def fingerprint(*parts: Column) -> Column:
    """A hash of the parts in which null differs from empty and no part can run into the next."""
    framed = (F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts)
    return F.sha2(F.concat_ws("|", *framed), 256)


def new_captures(incoming: DataFrame, held: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Rows of incoming that held does not have, once per key: an idempotent append."""
    return latest(incoming, keys, *order).join(held.select(*keys).distinct(), keys, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new, and those rows of old whose key is not in new."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def keep_children(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Children whose parent exists: what a cascading delete leaves."""
    return children.join(parents.select(*keys).distinct(), keys, "left_semi")


def preserve(fresh: DataFrame, held: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A fresh roster with a group of columns taken over from the held row of the same natural key; of several, the greatest."""
    once = latest(held.select(*keys, *columns), keys, *(F.desc(c) for c in columns))
    return fresh.drop(*columns).join(once, keys, "left")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of a total order: each task keeps n, so nothing is sorted whole."""
    return df.orderBy(*order).limit(n)


def with_total(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows, each with the number of all rows (total), counted by partial sums rather than one window."""
    return top(df, n, *order).withColumn("total", df.agg(F.count("*")).scalar())
