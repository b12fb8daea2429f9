"""What may be served: the release gate, typed filters, full records with their signals, source cards, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import money_words
from quillon.operators.keyed import first_rows, top, with_total

# The columns of a served record in their order, grades from best to worst, labels and caps.
RECORD_COLUMNS = [
    "crd", "family_office_name", "city", "state", "country", "founded_year", "aum_usd", "firm_phone", "investing_sectors", "investment_thesis",
    "description", "website", "corporate_linkedin", "primary_contact_name", "primary_contact_title", "primary_contact_email", "primary_email_grade",
    "primary_email_explanation", "secondary_contact_name", "secondary_contact_title", "secondary_contact_email", "secondary_email_grade",
    "secondary_email_explanation", "adv_filing_url", "entity_category", "person_status", "primary_authority_basis", "primary_selection_basis",
    "reachability_tier", "confidence_score", "data_asof", "release_basis", "release_basis_detail", "trust_state", "trust_reason", "last_checked_at",
]
GRADES = ["PUB", "A", "B", "C", "D", "F"]
OFFICES = ["single_family_office", "multi_family_office"]
CATEGORY_LABEL = {
    "multi_family_office": "multi-family office", "single_family_office": "single-family office", "wealth_manager": "wealth manager (NOT a family office)",
    "ria_with_fo_practice": "RIA with a family-office practice (NOT a family office)",
    "embedded_fo_practice": "advisory firm with an evidenced family-office practice (qualifying, but not a standalone family office)",
}
EMAIL_WORDING = {
    "PUB": "published by the firm for this person", "A": "vendor-reported deliverable for an inferred address (not proven to be this person's mailbox)",
    "B": "plausible inference on a catch-all domain, unconfirmable",
}
SEARCH_CAP, SEMANTIC_CAP, FIT_CAP, LOOKUP_CAP = 25, 10, 24, 3


def qualifying(records: DataFrame) -> DataFrame:
    """The one view that every serving path starts from."""
    return records.filter(F.col("release_state") == "qualifying")


def record_view(records: DataFrame) -> DataFrame:
    """The columns of a served record, in order; one that the records lack is null."""
    return records.select(*(F.col(c) if c in records.columns else F.lit(None).cast("string").alias(c) for c in RECORD_COLUMNS))


def constrained(records: DataFrame, state: str | None = None, least: int | None = None, most: int | None = None, city: str | None = None) -> DataFrame:
    """Qualifying records under typed filters; one that is empty or 0 is none, and a record without assets is in no band."""
    out = qualifying(records)
    if state:
        out = out.filter(F.upper("state") == state.upper())
    if city:
        out = out.filter(F.upper("city") == city.upper())
    if least:
        out = out.filter(F.col("aum_usd") >= least)
    if most:
        out = out.filter(F.col("aum_usd") <= most)
    return out


def with_signals(records: DataFrame, signals: DataFrame, most: int | None = None) -> DataFrame:
    """Records with `signals`: those of the key (crd, type, date, description), the newest first; none is an empty list."""
    rows = signals if most is None else first_rows(signals, ["crd"], most, F.desc("date"), F.asc("description"))
    newest = F.sort_array(F.collect_list(F.struct("date", "type", "description")), asc=False)
    each = rows.groupBy("crd").agg(newest.alias("signals"))
    none = F.array().cast("array<struct<date: string, type: string, description: string>>")
    return records.join(each, "crd", "left").withColumn("signals", F.coalesce("signals", none))


def hydrated(hits: DataFrame, records: DataFrame, signals: DataFrame) -> DataFrame:
    """Hits (crd and more) as full qualifying records with their signals; what is not released drops out here."""
    return hits.join(with_signals(qualifying(records), signals), "crd")


def slim(columns: dict[str, Column]) -> Column:
    """A record as JSON without what is null, empty text or an empty list."""
    full = lambda c: F.when(~F.to_json(F.struct(c.alias("x"))).isin("{}", '{"x":""}', '{"x":[]}'), c)
    return F.to_json(F.struct(*(full(c).alias(n) for n, c in columns.items())))


def grade_rank(grade: Column) -> Column:
    at = F.array_position(F.array(*map(F.lit, GRADES)), grade)
    return F.when(at > 0, at - 1).otherwise(9).cast("int")


def answer_order(score: Column, category: Column, grade: Column | None = None) -> list[Column]:
    """Family offices lead, then the better grade (where given), then the higher score; callers add a key."""
    office = F.when(category.isin(OFFICES), 0).otherwise(1)
    return [office, *([grade_rank(grade).asc()] if grade is not None else []), score.desc_nulls_last()]


def source_cards(hits: DataFrame, query: str = "query") -> DataFrame:
    """Hits of each query in the order of their cards (nth), with place, size in words and whether they are offices."""
    order = answer_order(F.coalesce("score", F.lit(0)), F.col("entity_category"), F.col("primary_email_grade"))
    place = F.nullif(F.concat_ws(", ", F.nullif("city", F.lit("")), F.nullif("state", F.lit(""))), F.lit(""))
    ranked = hits.withColumn("nth", F.row_number().over(Window.partitionBy(query).orderBy(*order, F.asc("crd"))))
    return ranked.withColumns({"location": place, "aum": money_words(F.nullif("aum_usd", F.lit(0))), "is_family_office": F.coalesce(F.col("entity_category").isin(OFFICES), F.lit(False))})


def withheld(records: DataFrame, most: int = 10) -> DataFrame:
    """(release_state, category, n, firms): what is held but not released, with the first `most` names; status only."""
    rest = records.filter(~F.col("release_state").eqNullSafe("qualifying"))
    firsts = first_rows(rest, ["release_state", "category"], most, F.asc("name"), F.asc("crd"))
    named = firsts.groupBy(F.col("release_state").alias("s"), F.col("category").alias("c")).agg(F.array_sort(F.collect_list("name")).alias("firms"))
    counted = rest.groupBy("release_state", "category").agg(F.count("*").alias("n"))
    same = F.col("release_state").eqNullSafe(F.col("s")) & F.col("category").eqNullSafe(F.col("c"))
    return counted.join(named, same).select("release_state", "category", "n", "firms")


def prompt_lines(r: dict[str, Column]) -> Column:
    """A record as the lines a composer reads: missing facts leave no line, a trust flag stands before the prose."""
    has = lambda c: F.coalesce(c.cast("string"), F.lit("")) != ""
    line = lambda head, c: F.when(has(c), F.concat(F.lit(head), c.cast("string")))
    place = F.nullif(F.concat_ws(", ", *(F.nullif(r[c], F.lit("")) for c in ("city", "state", "country"))), F.lit(""))
    facts = F.concat_ws(" | ", place, line("founded ", r["founded_year"]), line("AUM ", money_words(F.nullif(r["aum_usd"], F.lit(0)))))
    label, wording = (F.create_map(*(F.lit(x) for kv in d.items() for x in kv)) for d in (CATEGORY_LABEL, EMAIL_WORDING))
    contact = F.when(has(r["contact"]), F.concat(F.lit("Primary contact: "), r["contact"], F.lit(" ("), F.coalesce(r["title"], F.lit("principal")), F.lit(")"), F.coalesce(F.concat(F.lit(" -- "), r["email"], F.lit(" [grade "), r["grade"], F.lit(": "), F.coalesce(wording[r["grade"]], F.lit("ungraded")), F.lit("]")), F.lit(""))))
    return F.concat_ws(
        "\n", F.concat(r["name"], F.lit(" ("), F.when(facts != "", facts).otherwise("details n/a"), F.lit(")")), line("Entity type: ", label[r["category"]]),
        F.when(r["basis"] == "gate_released", "Release basis: established by the automated inclusion gate; NO decision-maker has been proven for this firm"),
        F.when((r["trust_state"] == "flagged") & has(r["trust_reason"]), F.concat(F.lit("TRUST FLAG (evidence changed since we recorded this): "), r["trust_reason"])),
        line("About: ", r["description"]), contact,
    )


def allowed_addresses(hits: DataFrame, query: str = "query") -> DataFrame:
    """(query, addresses): the only addresses an answer may write, sorted, in lower case; "none" where there is none."""
    both = F.explode(F.array("primary_contact_email", "secondary_contact_email"))
    said = hits.select(query, both.alias("e")).groupBy(query).agg(F.array_sort(F.collect_set(F.lower(F.nullif("e", F.lit(""))))).alias("list"))
    return said.select(query, F.when(F.size("list") > 0, F.array_join("list", ", ")).otherwise("none").alias("addresses"))


def structured_search(records: DataFrame, n: int = 15, sector: str | None = None, **filters) -> DataFrame:
    """The largest matching records with the total, at most SEARCH_CAP; a sector is looked for as text in `sectors`."""
    found = constrained(records, **filters)
    if sector:
        found = found.filter(F.contains(F.lower("sectors"), F.lit(sector.lower())))
    return with_total(found, min(n or 15, SEARCH_CAP), F.desc_nulls_last("aum_usd"), F.asc("crd"))


def get_record(records: DataFrame, name: str) -> DataFrame:
    """Qualifying records whose name holds the text, at most LOOKUP_CAP."""
    return top(qualifying(records).filter(F.contains(F.lower("name"), F.lit(name.strip().lower()))), LOOKUP_CAP, F.asc("name"), F.asc("crd"))
