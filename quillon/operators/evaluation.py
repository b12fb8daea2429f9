"""Measures against people's judgments: the title rubric, its bracket, gate and band against decisions, answer cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.rules import COUNTED

# Phrases of titles that mean control, those that only a lenient reading counts, corrections of single titles.
STRONG_TITLES = [
    "founder", "co founder", "owner", "managing member", "managing partner", "co managing partner", "managing principal", "chief executive", "ceo",
    "chairman", "chief investment officer", "portfolio manager", "head of investment", "head asset management", "head of asset management",
    "head markets", "head private markets", "head of private", "head of research", "head portfolio", "director of investments",
    "director investments", "managing director investments", "managing director of investments", "director of research", "director of portfolio",
    "investment manager",
]
LENIENT_TITLES = ["partner", "managing director", "senior partner"]
TITLE_OVERRIDES = {
    "Founder Emeritus": 0, "Head of North American Private Credit Origination & Partner": 1, "Member of the Board of Directors": 0,
}
OFFICES = ["single_family_office", "multi_family_office"]


def principal_title(title: Column, strict: bool = True) -> Column:
    """1 if a title alone says that its holder decides, else 0; the lenient reading also counts bare seniority."""
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z ]", " "), " +", " ")), F.lit(" "))
    holds = lambda phrases: F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(words, p))
    word = lambda w: F.contains(words, F.lit(f" {w} "))
    yes = holds(STRONG_TITLES) | word("principal") | word("cio") | (word("president") & ~word("vice president"))
    if not strict:
        yes = yes | holds(LENIENT_TITLES)
    ruled = F.when(F.contains(words, F.lit("emeritus")), 0).when(yes, 1).otherwise(0)
    if not strict:
        return ruled
    return F.coalesce(F.create_map(*(F.lit(x) for kv in TITLE_OVERRIDES.items() for x in kv))[title], ruled)


def truth_value(said: Column) -> Column:
    """A reviewer's yes or no as 1 or 0; anything else, and nothing, is no label."""
    low = F.lower(F.trim(said))
    return F.when(low.isin("1", "true", "yes", "y"), 1).when(low.isin("0", "false", "no", "n"), 0)


def rate(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def bracket(judged: DataFrame) -> DataFrame:
    """Confusion of predictions (truth, predicted, title) with the labels, and with the lenient reading of the titles.

    The rates against the labels and against the lenient reading enclose the true ones; a rate without cases is null.
    """
    rows = judged.filter(F.col("truth").isNotNull()).select("truth", F.coalesce("predicted", F.lit(0)).alias("p"), principal_title(F.col("title"), strict=False).alias("l"))
    cell = lambda c, t, p: F.count_if((F.col(c) == t) & (F.col("p") == p))
    sums = rows.agg(*(cell(c, t, p).alias(f"{c[0]}{t}{p}") for c in ("truth", "l") for t in (0, 1) for p in (0, 1)))
    c = F.col
    return sums.select(
        c("t11").alias("tp"), c("t01").alias("fp"), c("t00").alias("tn"), c("t10").alias("fn"), rate(c("t11"), c("t11") + c("t01")).alias("precision"), rate(c("t11"), c("t11") + c("t10")).alias("recall"),
        rate(c("t01"), c("t01") + c("t00")).alias("fpr"), rate(c("t10"), c("t10") + c("t11")).alias("fnr"), rate(c("t11") + c("t00"), c("t11") + c("t01") + c("t00") + c("t10")).alias("accuracy"),
        rate(c("l11"), c("l11") + c("l01")).alias("precision_lenient"), rate(c("l01"), c("l01") + c("l00")).alias("fpr_lenient"),
    )


def human_bucket(status: Column, category: Column, excluded: Column) -> Column:
    """What people decided on a labelled record, first match."""
    return (
        F.when(excluded, "human_excluded")
        .when((status == "affirmed") & category.isin(OFFICES), "human_affirmed_fo")
        .when(category == "ria_with_fo_practice", "human_ria_fo_practice")
        .when(category == "wealth_manager", "human_wealth_manager")
        .otherwise("human_quarantined")
    )


def gate_against_people(judged: DataFrame) -> DataFrame:
    """(bucket, decision, category, n, wrong): the gate's decisions in each bucket of people's (bucket, decision, category).

    wrong marks cells that disagree: an office that is not affirmed, or an excluded firm or wealth manager that is,
    unless as a practice.
    """
    counted = judged.groupBy("bucket", "decision", "category").agg(F.count("*").alias("n"))
    affirms = F.col("decision") == "affirm"
    missed = (F.col("bucket") == "human_affirmed_fo") & ~affirms
    leaked = F.col("bucket").isin("human_excluded", "human_wealth_manager") & affirms & ~F.coalesce(F.col("category") == "embedded_fo_practice", F.lit(False))
    return counted.withColumn("wrong", missed | leaked)


def gate_recall(judged: DataFrame) -> DataFrame:
    """(offices, affirmed, recall) of the gate on offices that people affirmed."""
    own = F.col("bucket") == "human_affirmed_fo"
    return judged.agg(F.count_if(own).alias("offices"), F.count_if(own & (F.col("decision") == "affirm")).alias("affirmed")).withColumn("recall", rate(F.col("affirmed"), F.col("offices")))


def band_precision(released: DataFrame) -> DataFrame:
    """Of records that the band releases (category, human_category, human_status, excluded): whether they belong to the set
    at all (counted), and whether those called an office are one (strict)."""
    counted = ~F.col("excluded") & F.coalesce(F.col("human_category").isin(*COUNTED, "ria_with_fo_practice"), F.lit(False))
    office = F.col("category").isin(OFFICES)
    proven = F.coalesce((F.col("human_status") == "affirmed") & F.col("human_category").isin(OFFICES), F.lit(False))
    sums = released.agg(F.count("*").alias("released"), F.count_if(counted).alias("counted"), F.count_if(office).alias("offices"), F.count_if(office & proven).alias("proven"))
    return sums.withColumns({"counted_precision": rate(F.col("counted"), F.col("released")), "strict_precision": rate(F.col("proven"), F.col("offices"))})


def reviewed_precision(verdicts: DataFrame) -> DataFrame:
    """Precision over the records that were reviewed (counted_ok, category_ok); null is not reviewed, and says so in `reviewed`."""
    seen, both = F.col("counted_ok").isNotNull(), F.col("counted_ok").isNotNull() & F.col("category_ok").isNotNull()
    sums = verdicts.agg(
        F.count("*").alias("total"), F.count_if(seen).alias("reviewed"), F.count_if("counted_ok").alias("counted"), F.count_if(both).alias("category_reviewed"), F.count_if(both & F.col("category_ok")).alias("category"),
        F.count_if(seen & (~F.col("counted_ok") | F.coalesce(~F.col("category_ok"), F.lit(False)))).alias("failures"),
    )
    return sums.withColumns({"counted_precision": rate(F.col("counted"), F.col("reviewed")), "category_precision": rate(F.col("category"), F.col("category_reviewed"))})


def case_rates(cases: DataFrame) -> DataFrame:
    """Rates of evaluation cases (grounded, expected, repaired); a case that could not be judged has failed."""
    ok = lambda c: F.coalesce(F.col(c), F.lit(False))
    sums = cases.agg(F.count("*").alias("cases"), F.count_if(ok("grounded")).alias("grounded"), F.count_if(ok("expected")).alias("expected"), F.count_if(ok("repaired")).alias("repaired"), F.count_if(~(ok("grounded") & ok("expected"))).alias("failures"))
    return sums.withColumns({"grounded_rate": rate(F.col("grounded"), F.col("cases")), "expectation_rate": rate(F.col("expected"), F.col("cases"))})
