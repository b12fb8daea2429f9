"""Loaders of human decisions and artifacts, exclusions, review sheets, ledger appends, schema versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.operators.keyed import latest
from quillon.operators.storage import shared_path

# What a decision may say, and whom each category is expected to have in charge.
DECISION_CATEGORIES = ["single_family_office", "multi_family_office", "embedded_fo_practice", "ria_with_fo_practice", "wealth_manager", "not_fo", "unresolved"]
EXPECTED = {
    "single_family_office": "family principal or the person running the family's capital",
    "multi_family_office": "CIO / head of investments (or the founding principal if small)",
    "embedded_fo_practice": "the person who leads the family-office practice, not the firm's CEO",
}
GATE_VERSION, BAND_VERSION, STALE_MONTHS = "gate-v2", "band-v1", 15
#: Columns of tables by version; a row of an older version has nulls in what came later.
VERSIONS = {
    "observations": {1: "key string, at timestamp, status string", 2: "key string, at timestamp, status string, content_hash string", 3: "key string, at timestamp, status string, content_hash string, run_id long"},
    "run_events": {1: "run_id long, phase string, event string, status string", 2: "run_id long, phase string, event string, status string, tokens long, micros long"},
}


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""


def ratified(decisions: DataFrame) -> DataFrame:
    """Decisions (key, category, status, rationale, decided_by, classes: array) with their outcome.

    refused: nobody has decided, or category or rationale are missing or unknown; demoted: affirmed on fewer than two
    classes of evidence, and so unresolved; else applied. status and category are those that take effect, null if refused.
    """
    refused = blank(F.col("decided_by")) | blank(F.col("rationale")) | ~F.coalesce(F.col("category").isin(DECISION_CATEGORIES), F.lit(False))
    single = (F.col("status") == "affirmed") & (F.size(F.array_distinct(F.coalesce("classes", F.array().cast("array<string>")))) < 2)
    outcome = F.when(refused, "refused").when(single, "demoted").otherwise("applied")
    judged = decisions.withColumn("outcome", outcome)
    effect = lambda c: F.when(F.col("outcome") == "applied", F.col(c)).when(F.col("outcome") == "demoted", "unresolved")
    return judged.withColumns({"status": effect("status"), "category": effect("category")})


def ratified_contacts(contacts: DataFrame) -> DataFrame:
    """Contacts (key, role, name, decided_by, published_email) that someone has decided on, the last (n) of each key and role."""
    return latest(contacts.filter(~blank(F.col("decided_by"))), ["key", "role"], F.desc("n")).withColumn("published", ~blank(F.col("published_email")))


def ratified_signals(signals: DataFrame) -> DataFrame:
    """Signals (key, date, description, source_url, decided_by) with a decision, a date and a source, once for each key and description."""
    kept = signals.filter(~blank(F.col("decided_by")) & ~blank(F.col("date")) & ~blank(F.col("source_url")))
    return latest(kept, ["key", "description"], F.asc("date"), F.asc("source_url"))


def reloaded(rows: DataFrame, path: str) -> DataFrame:
    """A table written anew, whatever it held before, and read."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def company_pages(found: DataFrame, firms: DataFrame) -> DataFrame:
    """Firms (key) with `linkedin` from rows (key, url, matched_on): only pages of companies, without a slash at the end."""
    url = F.regexp_replace(F.trim("url"), "/+$", "")
    pages = found.filter(F.contains(url, F.lit("linkedin.com/company/"))).select("key", url.alias("linkedin"), F.coalesce(F.nullif("matched_on", F.lit("")), F.lit("search")).alias("linkedin_source"))
    return firms.join(latest(pages, ["key"], F.asc("linkedin")), "key", "left")


def split_excluded(records: DataFrame, excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that stay, those that are excluded, with the reason) by a list (key, reason); the list is small, adaptive execution decides how to join."""
    return records.join(excluded.select("key").distinct(), "key", "left_anti"), records.join(latest(excluded, ["key"], F.asc("reason")), "key")


def review_sheet(firms: DataFrame, people: DataFrame, most: int = 10) -> DataFrame:
    """One JSON sheet for each firm (key, name, category) with up to `most` of its people (key, person, title, spans) and empty fields to decide in."""
    member = F.struct("person", "title", F.slice("spans", 1, 3).alias("spans"))
    each = people.groupBy("key").agg(F.slice(F.array_sort(F.collect_list(member)), 1, most).alias("people"))
    role = F.create_map(*(F.lit(x) for kv in EXPECTED.items() for x in kv))[F.col("category")]
    sheet = F.struct("key", "name", "category", F.coalesce(role, F.lit("unknown")).alias("expected"), F.coalesce("people", F.array().cast("array<struct<person: string, title: string, spans: array<string>>>")).alias("people"), F.lit("").alias("decided_by"))
    return firms.join(each, "key", "left").select("key", F.to_json(sheet).alias("sheet"))


def through_json(rows: DataFrame, name: str) -> DataFrame:
    """Rows written as JSON lines into the shared folder and read with their own schema."""
    path = shared_path(rows.sparkSession, name)
    rows.write.json(path)
    return rows.sparkSession.read.schema(rows.schema).json(path)


def appended(ledger: DataFrame | None, *stages: DataFrame) -> DataFrame:
    """The ledger with the rows that stages return, in one append; columns that a stage lacks are null."""
    parts = [ledger, *stages] if ledger is not None else list(stages)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def at_version(rows: DataFrame, name: str, version: int | None = None) -> DataFrame:
    """Rows of a table in the columns of a version (the newest, if none is given): later columns null, types as stated."""
    wanted = T.StructType.fromDDL(VERSIONS[name][version or max(VERSIONS[name])])
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted))


def decisions_from(spark: SparkSession, path: str) -> DataFrame:
    """(key, role, name, title, evidence) from research batches, JSON files of firms with a primary and a secondary person; nobody without a name."""
    person = "struct<name: string, title: string, evidence: map<string, string>>"
    batches = spark.read.option("multiLine", True).schema(f"key string, primary {person}, secondary {person}").json(path)
    roles = F.array(*(F.struct(F.lit(r).alias("role"), F.col(f"{r}.name").alias("name"), F.col(f"{r}.title").alias("title"), F.col(f"{r}.evidence").alias("evidence")) for r in ("primary", "secondary")))
    return batches.select("key", F.explode(roles).alias("p")).select("key", "p.*").filter(~blank(F.col("name")))


def scoped(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the named keys only: what a promotion rebuilds."""
    return rows.join(keys.select("key").distinct(), "key", "left_semi")


def versioned(rows: DataFrame) -> DataFrame:
    """Rows with the frozen versions of the rules that decided them."""
    return rows.withColumns({"gate_version": F.lit(GATE_VERSION), "band_version": F.lit(BAND_VERSION)})


def stale(state: Column, months: Column) -> Column:
    """Whether a qualifying record's facts are over STALE_MONTHS old; null where that cannot be said or is not asked."""
    return F.when((state == "qualifying") & months.isNotNull(), months > STALE_MONTHS)


def changed_facts(old: Column, new: Column) -> Column:
    """Keys whose values differ between two fact maps, null and missing being the same, in order."""
    keys = F.array_sort(F.array_distinct(F.concat(F.map_keys(old), F.map_keys(new))))
    return F.filter(keys, lambda k: ~old[k].eqNullSafe(new[k]))


def fact_value(facts: Column, field: Column) -> Column:
    """The value that a change of `field` speaks of: roster changes are about the roster, all else about itself."""
    return facts[F.when(field.isin("roster_gone", "roster_added"), "roster").otherwise(field)]


def maker_gone(confirmed: Column, primary: Column, roster: Column) -> Column:
    """Whether a proven contact has left: only where the change of the roster is confirmed."""
    name = F.lower(F.trim(F.coalesce(primary, F.lit(""))))
    return F.coalesce((name != "") & F.array_contains(confirmed, "roster_gone") & ~F.array_contains(F.transform(roster, lambda n: F.lower(F.trim(n))), name), F.lit(False))
