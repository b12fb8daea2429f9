"""Addresses for people: candidates by pattern, a deterministic verifier, and grading that stops at the first verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import name_parts

# The patterns in the order in which they are tried.
PATTERNS = ["first.last", "flast", "firstlast", "first", "first_last", "f.last", "lastf"]


def candidates(people: DataFrame, name: str = "name", domain: str = "domain") -> DataFrame:
    """One row per candidate address of each person: pos (from 0), pattern, email; none where no name is left."""
    first, last = name_parts(F.col(name))
    named = people.withColumn("#first", first).withColumn("#last", last)
    f, l, i, j = F.col("#first"), F.col("#last"), F.left("#first", F.lit(1)), F.left("#first", F.lit(1))
    local = [F.concat(f, F.lit("."), l), F.concat(i, l), F.concat(f, l), f, F.concat(f, F.lit("_"), l), F.concat(i, F.lit("."), l), F.concat(l, j)]
    full = F.array(*(F.struct(F.lit(p).alias("pattern"), F.concat(x, F.lit("@"), F.col(domain)).alias("email")) for p, x in zip(PATTERNS, local)))
    single = F.array(F.struct(F.lit("first").alias("pattern"), F.concat(f, F.lit("@"), F.col(domain)).alias("email")))
    options = F.when(l.isNotNull(), full).when(f.isNotNull(), single)
    return named.select(*people.columns, F.posexplode(options).alias("pos", "c")).select(*people.columns, "pos", "c.pattern", "c.email")


def mock_verdict(email: Column) -> Column:
    """The deterministic verifier: catch-all domains by name, dotted local parts deliverable, all else invalid."""
    local, domain = F.substring_index(email, "@", 1), F.substring_index(email, "@", -1)
    return F.when(F.contains(domain, F.lit("catchall")), "catch_all").when((F.instr(local, ".") > 0) & ~F.endswith(local, F.lit(".")), "ok").otherwise("invalid")


def graded(options: DataFrame, keys: list[str], tried: int = 4) -> DataFrame:
    """Grade of each person from verdicts on the first `tried` candidates (pos, pattern, email, result).

    The first verdict that settles the matter counts: ok A, catch_all B with the default address, disposable D. If all
    were invalid the grade is D, if nothing settled it C; both keep the default address.
    """
    final = F.col("result").isin("ok", "catch_all", "disposable")
    this = F.struct("pos", "pattern", "email", "result")
    one = options.filter(F.col("pos") < tried).groupBy(*keys).agg(F.min(F.when(final, this)).alias("end"), F.min(this).alias("default"), F.bool_and(F.col("result") == "invalid").alias("all_invalid"))
    settled = F.col("end.result")
    grade = F.when(settled == "ok", "A").when(settled == "catch_all", "B").when(settled == "disposable", "D").when(F.col("all_invalid"), "D").otherwise("C")
    code = F.when(settled == "ok", "VERIFIED_API").when(settled == "catch_all", "INFERRED_CATCHALL").when(settled == "disposable", "RISKY_DISPOSABLE").when(F.col("all_invalid"), "INVALID_API").otherwise("UNKNOWN_API")
    own = settled.isin("ok", "disposable")
    return one.select(*keys, F.when(own, F.col("end.email")).otherwise(F.col("default.email")).alias("email"), grade.alias("grade"), code.alias("code"))


def domain_blocked(people: DataFrame, unknown: Column, keys: list[str], order: list[str]) -> DataFrame:
    """Marks all people of a domain after the first whose answer was unknown, in the order given, as blocked."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return people.withColumn("blocked", F.coalesce(F.max(unknown.cast("int")).over(before) > 0, F.lit(False)))


def ladder(mx_ok: Column, catch_all: Column, provider: Column, code: Column, published: Column) -> Column:
    """Grade from a mail server's answers: none F, catch-all B, unclear or shielded C, accepted A (A+ if published), rejected C."""
    accepted = (code >= 200) & (code < 300)
    return (
        F.when(~F.coalesce(mx_ok, F.lit(False)), "F")
        .when(catch_all, "B")
        .when(catch_all.isNull() | (provider == "microsoft365"), "C")
        .when(accepted & published, "A+")
        .when(accepted, "A")
        .otherwise("C")
    )
