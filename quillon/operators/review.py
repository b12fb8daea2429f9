"""Review and answer checks: drafts, mentions of authority, notes, name resolution, the gate over a composed answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import EMAIL, money_words

# Fixed values that results depend on.
SELF_DESCRIPTIONS = [
    ("single_family_office", "(?i)\\b(single[- ]family office|serv\\w+ (one|a single) family)\\b"),
    ("multi_family_office", "(?i)\\bmulti[- ]family office\\b"),
    ("ria_with_fo_practice", "(?i)\\bfamily office (services|practice|group|division)\\b"),
    ("wealth_manager", "(?i)\\b(wealth management firm|registered investment advis[oe]r|investment management firm)\\b"),
]
AUTHORITY = (
    "(?i)\\b(allocat\\w+|invest\\w+ (?:committee|strategy|decisions?|process)|asset allocation|portfolio construction|security selection|"
    "manages? (?:the )?(?:portfolio|assets|investments)|oversees? (?:the )?(?:portfolio|investments|assets)|chairs? the invest\\w+|"
    "chief investment officer|head of invest\\w+|directs? (?:the )?invest\\w+)\\b"
)
RECOMMENDS = "(?i)\\b(recommend|suggest|approach|contact|reach out|pitch|target|consider|pursue|shortlist|best fit|good fit|strong fit|worth (?:a look|approaching|contacting))\\b"
SUPPORT_TITLE = "marketing|business development|client service|relationship|operations|compliance|counsel|administrat"
KNOWN_SECTORS = ["real estate", "healthcare", "technology", "private equity", "venture", "energy", "consumer", "financial", "industrials", "biotech", "infrastructure", "hospitality"]
TITLED = "\\b(Managing Partner|Managing Director|Chief Investment Officer|CIO|Founder|Co-Founder|President|Chairman|Partner|Principal|CEO|Controller|Office Manager|Accountant|Bookkeeper|Analyst|Manager)\\s+([A-Z][a-z]+ [A-Z][a-z]+)"
PRINCIPALS = ["managing partner", "managing director", "chief investment officer", "cio", "founder", "co-founder", "president", "chairman", "partner", "principal", "ceo"]


def extracted(text: Column) -> dict[str, Column]:
    """Profile facts by rule, the deterministic stand-in for a model: sectors, founding year, team."""
    low = F.lower(text)
    titles, names = F.regexp_extract_all(text, F.lit(TITLED), F.lit(1)), F.regexp_extract_all(text, F.lit(TITLED), F.lit(2))
    member = lambda n, t: F.struct(n.alias("name"), t.alias("title"), F.lower(t).isin(PRINCIPALS).alias("is_principal"))
    return {
        "sectors": F.filter(F.array(*map(F.lit, KNOWN_SECTORS)), lambda s: F.contains(low, s)),
        "founded_year": F.nullif(F.regexp_extract(text, "\\b((19|20)\\d{2})\\b", 1), F.lit("")).cast("int"),
        "team": F.zip_with(names, titles, member),
    }


def draft_category(site: Column, hnw: Column, other: Column) -> tuple[Column, Column]:
    """(category, note): what the firm calls itself, sharpened or contradicted by its client mix."""
    total = F.coalesce(hnw, F.lit(0)) + F.coalesce(other, F.lit(0))
    said = F.when(F.lit(False), None)
    for category, pattern in SELF_DESCRIPTIONS:
        said = said.when(site.rlike(pattern), category)
    retail = (said == "multi_family_office") & (total > 100)
    category = F.when(retail, "wealth_manager").otherwise(F.coalesce(said, F.lit("unresolved")))
    note = (
        F.when((said == "single_family_office") & (total > 5), "clients contradict one family")
        .when(said == "single_family_office", "clients consistent")
        .when(retail, "retail-scale book")
        .when(said.isNotNull(), "self-described")
        .when((total > 0) & (total <= 10) & (F.coalesce(hnw, F.lit(0)) >= F.coalesce(other, F.lit(0))), "one class of evidence only")
        .otherwise("no self-description")
    )
    return category, note


def mentions(pages: DataFrame, people: DataFrame, most: int = 6) -> DataFrame:
    """(key, name, span, authority, roster): sentences of a firm's pages (key, text) that name a person (key, name).

    Authority counts only from the quoted sentence, and not where it lists two or more other people of the firm.
    """
    sentences = pages.select("key", F.explode(F.split(F.regexp_replace("text", "\\s+", " "), "(?<=[.!?])\\s+")).alias("s")).select("key", F.substring(F.trim("s"), 1, 400).alias("span"))
    staff = people.groupBy("key").agg(F.collect_set(F.lower("name")).alias("all"))
    named = sentences.join(people, "key").filter(F.contains(F.lower("span"), F.lower("name"))).join(staff, "key")
    others = F.size(F.filter("all", lambda o: (o != F.lower(F.col("name"))) & F.contains(F.lower(F.col("span")), o)))
    marked = named.withColumn("roster", others >= 2).withColumn("authority", F.col("span").rlike(AUTHORITY) & ~F.col("roster"))
    best = F.struct((~F.col("authority")).alias("x"), F.col("roster").alias("y"), (-F.length("span")).alias("z"), "span", "authority", "roster")
    top = marked.groupBy("key", "name").agg(F.slice(F.array_sort(F.collect_set(best)), 1, most).alias("m"))
    return top.select("key", "name", F.explode("m").alias("m")).select("key", "name", "m.span", "m.authority", "m.roster")


def reviewer_note(n_mentions: Column, n_authority: Column, title: Column, category: Column, employees: Column, email: Column) -> Column:
    """The ways in which a title may be mistaken for authority, as one text."""
    low = F.lower(F.coalesce(title, F.lit("")))
    return F.concat_ws(
        " | ",
        F.when(n_mentions == 0, "no passage names this person").when(n_authority == 0, "no mention states authority").otherwise("authority stated; read the span"),
        F.when(low.rlike(SUPPORT_TITLE), "title is not an investment role"),
        F.when(low.rlike("founder|president|ceo|chief executive") & (category == "embedded_fo_practice"), "firm-level leader at an embedded practice"),
        F.when(employees <= 2, "very small staff"),
        F.when(F.coalesce(email, F.lit("")) == "", "no published address"),
    )


def resolved_names(asked: DataFrame, held: DataFrame, most: int = 1000) -> DataFrame:
    """(name, key): names asked for, matched exactly or, if just one held name (key, held) contains it or lies in it, by part.

    asked is one answer's picks: at most `most` names, which is checked, go to every task, and held is scanned once.
    """
    names = asked.select("name").distinct()
    if names.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} names in one answer")
    own, other = F.lower(F.trim("name")), F.lower("held")
    part = F.contains(other, own) | F.contains(own, other)
    found = held.join(F.broadcast(names), part).select("key", "name", (own == other).alias("exact"))
    counted = found.groupBy("name").agg(F.count("*").alias("n"), F.min(F.when(F.col("exact"), F.col("key"))).alias("own"), F.min("key").alias("one"))
    return counted.select("name", F.coalesce("own", F.when(F.col("n") == 1, F.col("one"))).alias("key"))


def pick_failures(picks: DataFrame, records: DataFrame) -> DataFrame:
    """(firm, failures) of picks (firm, key, confidence, text) against records (key, pickable, emails, tier)."""
    joined = picks.join(records, "key", "left")
    said = F.transform(F.regexp_extract_all("text", F.lit(EMAIL), F.lit(0)), F.lower)
    strange = F.size(F.array_except(said, F.coalesce("emails", F.array().cast("array<string>")))) > 0
    known = F.col("pickable").isNotNull()
    tests = [
        (~known, "not_a_record"),
        (known & ~F.col("pickable"), "not_releasable"),
        (known & strange, "email_not_on_record"),
        ((F.col("tier") == "insufficient_evidence") & F.col("confidence").isin("strong", "moderate"), "confidence_above_evidence"),
        ((F.col("tier") == "weak") & (F.col("confidence") == "strong"), "strong_over_weak"),
    ]
    return joined.select("firm", F.filter(F.array(*(F.when(c, f) for c, f in tests)), lambda x: x.isNotNull()).alias("failures"))


def recommends(text: Column, name: Column) -> Column:
    """Whether a text pushes a firm of that name (6 letters or more): a verb of recommendation within 120 characters of any mention."""
    low, n = F.lower(text), F.lower(F.trim(name))
    # The mentions part the text; each is looked at with 120 characters of what stands before and after it.
    parts = F.split(low, F.concat(F.lit("\\Q"), n, F.lit("\\E")))
    before, after = F.slice(parts, 1, F.size(parts) - 1), F.slice(parts, 2, F.size(parts))
    around = F.zip_with(before, after, lambda a, b: F.concat(F.right(a, F.lit(120)), n, F.left(b, F.lit(120))))
    known = (F.length(n) >= 6) & F.contains(low, n)
    return F.coalesce(F.when(known, F.exists(around, lambda w: w.rlike(RECOMMENDS))), F.lit(False))


def stated_places(goals: DataFrame, places: DataFrame, longest: int = 4, most: int = 10_000) -> DataFrame:
    """(id, place): places (place, at least 5 letters, up to `longest` words) that a goal (id, text) names as whole words.

    Up to `most` places, which is checked, go to every task; with more the runs of words are shuffled to them. The runs of
    goals are never broadcast: Spark takes their size for that of the goals before they are exploded.
    """
    words = F.filter(F.split(F.lower("text"), "[^\\p{L}\\p{N}_]+"), lambda w: w != "")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.transform(F.col("ws"), lambda _, i: F.array_join(F.slice(F.col("ws"), i + 1, n), " "))))
    said = goals.select("id", F.explode(F.array(words)).alias("ws")).select("id", F.explode(F.array_distinct(runs)).alias("run"))
    known = places.filter(F.length("place") >= 5).select("place", F.trim(F.regexp_replace(F.lower("place"), "[^\\p{L}\\p{N}_]+", " ")).alias("run")).distinct()
    known = F.broadcast(known) if known.limit(most + 1).count() <= most else known.hint("merge")
    return said.join(known, "run").select("id", "place").distinct()


def prose(name: Column, label: Column, place: Column, founded: Column, aum: Column, thesis: Column, sectors: Column) -> Column:
    """A record as the text that is indexed; its category is stated as it is."""
    return F.concat(
        name, F.lit(" is a "), label,
        F.coalesce(F.concat(F.lit(" based in "), place), F.lit("")),
        F.coalesce(F.concat(F.lit(", founded "), founded.cast("string")), F.lit("")), F.lit("."),
        F.coalesce(F.concat(F.lit(" Assets: "), money_words(aum), F.lit(".")), F.lit("")),
        F.coalesce(F.concat(F.lit(" Thesis: "), thesis), F.lit("")),
        F.when(F.size(sectors) > 0, F.concat(F.lit(" Sectors: "), F.array_join(sectors, ", "), F.lit("."))).otherwise(""),
    )


def registry_events(held: DataFrame, live: DataFrame) -> DataFrame:
    """(key, events): what the registry's current answer (key, found, filed, scope, name) says against the held record.

    held has (key, filed, name, scope): the last scope seen. A lapse and a disappearance are said once, a new name always.
    """
    h = held.select("key", *(F.col(c).alias(f"held_{c}") for c in ("filed", "name", "scope")))
    j = h.join(live, "key")
    was = F.coalesce("held_scope", F.lit("ACTIVE"))
    tests = [
        (F.col("found") & (F.col("filed") > F.col("held_filed")), "filing_moved"),
        (F.col("found") & (F.col("scope") != "ACTIVE") & (was == "ACTIVE"), "registration_lapsed"),
        (F.col("found") & (F.upper(F.trim("name")) != F.upper(F.trim("held_name"))), "name_changed"),
        (~F.col("found") & F.col("held_scope").isNotNull() & (F.col("held_scope") != "not_found"), "registration_gone"),
    ]
    return j.select("key", F.filter(F.array(*(F.when(c, e) for c, e in tests)), lambda x: x.isNotNull()).alias("events"))


def materiality(error: Column, baseline: Column, pages: Column, confirmed: Column, oscillating: Column, unconfirmed: Column) -> Column:
    """Verdict on a changed page from the counts of confirmed, oscillating and unconfirmed facts."""
    return F.when(error, "error").when(~baseline, "no_baseline").when(pages == 0, "refetch_empty").when(confirmed > 0, "material").when(oscillating > 0, "oscillating").when(unconfirmed > 0, "unconfirmed").otherwise("cosmetic")


def first_calls(calls: DataFrame) -> DataFrame:
    """Calls (session, step, name, args) without repeats of a name with the same arguments in a session."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("session", "name", "args").orderBy("step"))
    return calls.withColumn("#n", nth).filter(F.col("#n") == 1).drop("#n")


def merged_details(old: DataFrame, patch: DataFrame, key: str = "key") -> DataFrame:
    """(key, detail): maps of old with the patch laid over them; keys of the patch win, the rest survive."""
    joined = old.withColumnRenamed("detail", "a").join(patch.withColumnRenamed("detail", "b"), key, "full")
    empty = F.create_map().cast("map<string,string>")
    a, b = F.coalesce("a", empty), F.coalesce("b", empty)
    return joined.select(key, F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b).alias("detail"))
