"""Release of records: decisions, precedence, contacts, surfaces and the checks over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.rules import COUNTED


def adjudicated(status: Column, duplicate_of: Column) -> Column:
    """State that an entity decision gives: what is not affirmed, or is a duplicate, is quarantined."""
    return F.when(status.isNull(), "unresolved").when(status.isin("rejected", "unresolved"), "quarantined").when(duplicate_of.isNotNull(), "quarantined").otherwise("unresolved")


def precedence(status: Column, category: Column, duplicate_of: Column, has_contact: Column, gate_affirms: Column, in_band: Column) -> dict[str, Column]:
    """The four ways to a release state, first match; excluded records are left out before."""
    counted, affirmed = F.coalesce(category.isin(COUNTED), F.lit(False)), (status == "affirmed") & duplicate_of.isNull()
    ratified, human = F.coalesce(affirmed, F.lit(False)) & counted & has_contact, F.coalesce(affirmed, F.lit(False)) & counted
    by_gate = status.isNull() & gate_affirms & in_band
    return {
        "release_state": F.when(human | by_gate, "qualifying").otherwise(adjudicated(status, duplicate_of)),
        "release_basis": F.when(human, "human_ratified").when(by_gate, "gate_released"),
        "person_status": F.when(ratified, "proven").when(human | by_gate, "not_established"),
    }


def contact_email(published: Column, inferred: Column, grade: Column, rejected: Column) -> tuple[Column, Column, Column]:
    """(email, grade, outcome): published first, then inferred A or B; an address in `rejected` (array, lower case) never ships."""
    refused = lambda e: F.array_contains(rejected, F.lower(e))
    by_site = published.isNotNull() & ~F.coalesce(refused(published), F.lit(False))
    by_guess = grade.isin("A", "B") & inferred.isNotNull() & ~F.coalesce(refused(inferred), F.lit(False))
    email = F.when(by_site, published).when(by_guess, inferred)
    out = F.when(by_site, "PUB").when(by_guess, grade)
    outcome = F.when(by_site, "published").when(by_guess, "inferred").when(refused(inferred), "withheld_rejected").when(grade == "C", "withheld_unconfirmed").when(grade.isin("D", "F") & inferred.isNotNull(), "audited").otherwise("none")
    return email, out, outcome


def surface(state: Column, category: Column) -> Column:
    """The one export surface of each record; those without a decision have a surface of their own."""
    return (
        F.when(state == "quarantined", "quarantined")
        .when((state == "qualifying") & (category == "embedded_fo_practice"), "practices")
        .when(state == "qualifying", "product")
        .when(category.isNull(), "awaiting_adjudication")
        .when(category.isin(COUNTED), "pending")
        .otherwise("reclassified")
    )


def checks(rows: DataFrame, offending: dict[str, Column], by: str | None = None) -> DataFrame:
    """(check, failures, ok), all counted in one pass over the rows; each check is a condition that no row may meet.

    With `by` the same pass also counts the rows of each value of that column, as "by:value", which are no checks.
    """
    counts = [F.count_if(c).alias(n) for n, c in offending.items()]
    partial = rows.groupBy(*([by] if by else [])).agg(F.count("*").alias("#n"), *counts)
    each = [F.struct(F.lit(n).alias("check"), F.col(n).alias("failures"), F.lit(True).alias("checked")) for n in offending]
    if by:
        each.append(F.struct(F.concat(F.lit(f"{by}:"), by).alias("check"), F.col("#n").alias("failures"), F.lit(False).alias("checked")))
    listed = partial.select(F.explode(F.array(*each)).alias("c")).groupBy("c.check", "c.checked").agg(F.sum("c.failures").alias("failures"))
    return listed.select("check", "failures", (F.col("checked") & (F.col("failures") == 0)).alias("ok"))


def suppressed(row: DataFrame, columns: list[str], keep: Column) -> DataFrame:
    """Contact columns made null where they may not be shown."""
    return row.withColumns({c: F.when(keep, F.col(c)) for c in columns})
