"""Rule ladders over firm records as Column expressions: discovery tiers, gate, release, scores, contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.plan import once

# Fixed values that results depend on.
STRONG_NAME = "(?i)\\b((multi[\\s-]?|single[\\s-]?)?family\\s+offices?)\\b"
MEDIUM_NAME = "(?i)\\bfamily\\s+(capital|wealth|partners|investments?|holdings|advisor|advisors|advisers|group|trust|management|enterprises?)\\b"
MEDIUM_SHORT = "\\bMFO\\b"
FREE_TEXT = "(?i)family\\s+office"
SITE_PRACTICE = "(?i)family[\\s-]+office\\s+(services?|practice|group|division|team|solutions)"
SITE_PHRASE = "(?i)family[\\s-]+office"
ONE_FAMILY = "(?i)\\bsingle[\\s-]?family\\b|\\bone\\s+family\\b"
SERVES_FAMILIES = "(?i)\\bfamil(y|ies)\\b"
MIX_SHARE, MIX_CLIENTS = 0.75, 15
AFFIRM, EMBEDDED, MORE_EVIDENCE = 60, 40, 30
BAND_SHARE, BAND_RETAIL, BAND_SCORE = 0.90, 15, 100
COUNTED = ["single_family_office", "multi_family_office", "embedded_fo_practice"]


def zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where there is no whole."""
    return F.when(zero(whole) != 0, zero(part).cast("double") / whole.cast("double"))


def discovery_tier(name: Column, free_text: Column, share: Column, clients: Column) -> Column:
    """First match: the name says it, free text says it, the name hints at it, the client mix has the shape."""
    return (
        F.when(name.rlike(STRONG_NAME), "strong")
        .when(F.coalesce(free_text, F.lit("")).rlike(FREE_TEXT), "strong_text")
        .when(name.rlike(MEDIUM_NAME) | name.rlike(MEDIUM_SHORT), "medium")
        .when((F.coalesce(share, F.lit(0.0)) >= MIX_SHARE) & (clients > 0) & (clients <= MIX_CLIENTS), "client_mix")
    )


RULES = {"name_fo_strong": 40, "site_fo_practice": 25, "site_fo_selfdesc": 20, "adv_freetext_fo": 15, "structural_fo_shape": 20, "domain_fo": 10, "silver_fo_desc": 10}
AGAINST = {"institutional_scale": -40, "retail_scale": -25}


def gate(firms: DataFrame) -> DataFrame:
    """The inclusion gate over firms (name, site, fo_page, free_text, raum, hnw_raum, hnw, other, employees, domain, profile).

    Adds share, score, decision, category, and evidence and contradictions as arrays of (rule, points). The tests are
    columns of their own first, so that each is computed once, however often the ladder refers to it.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    share, clients = ratio(F.col("hnw_raum"), F.col("raum")), zero(F.col("hnw")) + zero(F.col("other"))
    basic = firms.withColumns({
        "share": share, "#clients": clients,
        "name_fo_strong": text("name").rlike(STRONG_NAME),
        "site_fo_practice": text("site").rlike(SITE_PRACTICE) | F.coalesce("fo_page", F.lit(False)),
        "site_fo_selfdesc": F.regexp_count(text("site"), F.lit(SITE_PHRASE)) >= 2,
        "adv_freetext_fo": text("free_text").rlike(FREE_TEXT),
        "domain_fo": F.contains(F.regexp_replace(text("domain"), "-", ""), F.lit("familyoffice")),
        "institutional_scale": (zero(F.col("raum")) > 15_000_000_000) | (zero(F.col("employees")) > 150),
        "retail_scale": zero(F.col("other")) > 100,
        "#one_family": text("name").rlike(ONE_FAMILY),
    })
    few = (F.col("#clients") > 0) & (F.col("#clients") <= MIX_CLIENTS)
    named = F.col("site_fo_practice") | F.col("name_fo_strong") | F.col("adv_freetext_fo")
    tested = basic.withColumns({
        "structural_fo_shape": (zero(F.col("raum")) != 0) & (F.coalesce("share", F.lit(0.0)) >= MIX_SHARE) & few,
        "silver_fo_desc": text("profile").rlike(SERVES_FAMILIES) & named,
    })
    c = F.col
    scored = once(tested, {"score": sum((F.when(c(r), p).otherwise(0) for r, p in (RULES | AGAINST).items()), F.lit(0))})
    core = c("name_fo_strong") | c("site_fo_practice") | c("adv_freetext_fo") | c("site_fo_selfdesc")
    published = c("site_fo_practice") | c("site_fo_selfdesc") | c("domain_fo") | c("silver_fo_desc")
    net = c("score") + F.when(c("retail_scale"), -AGAINST["retail_scale"]).otherwise(0)
    embedded = ~c("name_fo_strong") & c("site_fo_practice") & c("adv_freetext_fo") & ~c("institutional_scale") & (net >= EMBEDDED)
    enough = c("score") >= MORE_EVIDENCE
    step = F.when(~published & core & enough, "hold").when(~core, "weak").when(embedded, "embedded").when(c("score") >= AFFIRM, "affirm").otherwise("weak")
    stepped = once(scored, {"#step": step})
    single = c("#one_family") | (c("name_fo_strong") & (c("#clients") > 0) & (c("#clients") <= 2) & ~c("retail_scale"))
    listed = lambda some: F.filter(F.array(*(F.when(c(r), F.struct(F.lit(r).alias("rule"), F.lit(p).alias("points"))) for r, p in some.items())), lambda x: x.isNotNull())
    return stepped.select(
        *firms.columns, "share", "score",
        F.when(c("#step").isin("embedded", "affirm"), "affirm").when((c("#step") == "hold") | enough, "needs_evidence").otherwise("exclude").alias("decision"),
        F.when(c("#step") == "embedded", "embedded_fo_practice").when((c("#step") == "affirm") & single, "single_family_office").when(c("#step") == "affirm", "multi_family_office").alias("category"),
        listed(RULES).alias("evidence"), listed(AGAINST).alias("contradictions"),
    )


def release_band(decision: Column, score: Column, share: Column, other: Column) -> dict[str, Column]:
    """Whether an affirmed record is released without review, and by which route."""
    mix = share.isNotNull() & (share >= BAND_SHARE) & (zero(other) <= BAND_RETAIL)
    route = F.when(decision != "affirm", "not_affirmed").when(mix, "client_mix").when(score >= BAND_SCORE, "concordant").when(share.isNull(), "no_mix").otherwise("mix_inconsistent")
    return {"route": route, "released": route.isin("client_mix", "concordant")}


def title_rank(title: Column) -> Column:
    """Seniority of a job title, the first level that fits."""
    t = F.lower(F.coalesce(title, F.lit("")))
    word = lambda w: t.rlike(f"\\b{w}\\b")
    return (
        F.when(t.rlike("founder|owner|managing member"), 100)
        .when(F.contains(t, F.lit("managing partner")), 95)
        .when(word("chief executive") | word("ceo"), 90)
        .when(word("president") & ~F.contains(t, F.lit("vice")), 85)
        .when(word("chairman"), 84)
        .when(word("chief investment officer") | word("cio"), 80)
        .when(word("principal"), 70)
        .when(F.contains(t, F.lit("portfolio manager")), 60)
        .when(F.contains(t, F.lit("managing director")), 50)
        .when(F.contains(t, F.lit("partner")), 45)
        .otherwise(10)
    )


def completion(*cells: Column) -> Column:
    """Share of cells that are filled, in whole percent."""
    filled = sum((F.when(F.coalesce(c.cast("string"), F.lit("")) != "", 1).otherwise(0) for c in cells), F.lit(0))
    return F.bround(100 * filled / len(cells)).cast("int")


def reachability(qualifying: Column, proven: Column, grade: Column, phone: Column, linkedin: Column) -> tuple[Column, Column]:
    """(tier, score) of how directly a proven contact is reached; null unless the record qualifies and the person is proven."""
    has_phone, has_page = F.coalesce(phone, F.lit("")) != "", F.coalesce(linkedin, F.lit("")) != ""
    score = F.when(grade == "PUB", 100).when(grade == "A", 85).when(grade == "B", 60).when(has_phone & has_page, 45).when(has_phone | has_page, 25).otherwise(0)
    score = F.when(qualifying & proven, score)
    return F.when(score >= 85, "High").when(score >= 45, "Medium").when(score.isNotNull(), "Low"), score


def confidence(qualifying: Column, basis: Column, grade: Column) -> Column:
    """How well proven a qualifying record is: entity, person and address."""
    person = F.when(F.coalesce(basis, F.lit("")) == "stated", 40).otherwise(25)
    address = F.when(grade == "PUB", 20).when(grade.isin("A", "B"), 10).otherwise(5)
    return F.when(qualifying, F.least(F.lit(100), F.lit(40) + person + address))


def channel(primary_grade: Column, primary: Column, secondary_grade: Column, secondary: Column, phone: Column, linkedin: Column, website: Column) -> tuple[Column, Column]:
    """(channel, target) of outreach: the primary's address, the secondary's, phone, page, else research."""
    usable = lambda g, e: g.isin("PUB", "A", "B") & (F.coalesce(e, F.lit("")) != "")
    one, two = usable(primary_grade, primary), usable(secondary_grade, secondary)
    has = lambda x: F.coalesce(x, F.lit("")) != ""
    kind = F.when(one | two, "email").when(has(phone), "phone").when(has(linkedin), "linkedin").otherwise("research")
    target = F.when(one, primary).when(two, secondary).when(has(phone), phone).when(has(linkedin), linkedin).otherwise(website)
    return kind, target


def reach_class(status: Column) -> Column:
    """Of a stored observation: reachable (2xx, 3xx), throttled (429), unreachable, or transient (an error, or none)."""
    code = status.try_cast("int")
    return F.when(code.isNull(), "transient").when((code >= 200) & (code < 400), "reachable").when(code == 429, "throttled").otherwise("unreachable")
