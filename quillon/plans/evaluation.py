"""Queries of measures against people's judgments."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.operators import evaluation
from quillon.plans.records import FIRMS_SQL, cases, gated, table
from quillon.registry import query

# Titles in the forms that the rubric has to handle, by order number, with the strict and the lenient verdict.
TITLES = [
    ("Co-Founder & CEO", 1, 1), ("Founder Emeritus", 0, 0), ("Vice President", 0, 0), ("President", 1, 1), ("Partner", 0, 1), ("Managing Director", 0, 1), ("Chief of Staff", 0, 0),
    ("Head of North American Private Credit Origination & Partner", 1, 1), ("CIO", 1, 1), ("Principals' assistant", 0, 0), (None, 0, 0),
]


def _titles():
    # Null has no verdict of its own: the last number stands for it.
    return F.element_at(F.array(*(F.lit(t) for t, _, _ in TITLES)), (F.col("o_orderkey") % len(TITLES) + 1).cast("int"))


def _verdict(which):
    return f"([{', '.join(str(t[which]) for t in TITLES)}])[o_orderkey % {len(TITLES)} + 1]"


@query("title_rubric", f"select o_orderkey as id, {_verdict(1)} as strict, {_verdict(2)} as lenient from orders")
def title_rubric(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), _titles().alias("title"))
    return rows.select("id", evaluation.principal_title(F.col("title")).alias("strict"), evaluation.principal_title(F.col("title"), strict=False).alias("lenient"))


JUDGED_SQL = f"j as (select case o_orderkey % 7 when 0 then 1 when 1 then 0 when 2 then null else {_verdict(1)} end as truth, case when o_orderkey % 3 = 0 then 1 when o_orderkey % 3 = 1 then 0 end as predicted, {_verdict(2)} as l from orders)"


@query(
    "title_rubric_bracket",
    f"""with {JUDGED_SQL}, c as (select count(*) filter (where truth = 1 and p = 1) as tp, count(*) filter (where truth = 0 and p = 1) as fp, count(*) filter (where truth = 0 and p = 0) as tn, count(*) filter (where truth = 1 and p = 0) as fn,
      count(*) filter (where l = 1 and p = 1) as ltp, count(*) filter (where l = 0 and p = 1) as lfp, count(*) filter (where l = 0 and p = 0) as ltn from (select truth, coalesce(predicted, 0) as p, l from j where truth is not null))
    select tp, fp, tn, fn, tp / (tp + fp) as precision, tp / (tp + fn) as recall, fp / (fp + tn) as fpr, fn / (fn + tp) as fnr, (tp + tn) / (tp + fp + tn + fn) as accuracy, ltp / (ltp + lfp) as precision_lenient, lfp / (lfp + ltn) as fpr_lenient from c""",
)
def title_rubric_bracket(spark, sf):
    k = F.col("o_orderkey")
    said = cases(k % 7, [(0, "Yes"), (1, " n "), (2, "unsure")])
    title = _titles()
    truth = F.when(k % 7 < 3, evaluation.truth_value(said)).otherwise(evaluation.principal_title(title))
    return evaluation.bracket(table(spark, sf, "orders").select(truth.alias("truth"), cases(k % 3, [(0, 1), (1, 0)]).alias("predicted"), title.alias("title")))


HUMAN = ["single_family_office", "multi_family_office", "ria_with_fo_practice", "wealth_manager", "not_fo"]
HUMAN_SQL = f"""h as (select *, case when crd % 3 < 2 then 'affirmed' else 'rejected' end as status, {HUMAN}[crd % 5 + 1] as human, crd % 17 = 0 as excluded from gated),
b as (select *, case when excluded then 'human_excluded' when status = 'affirmed' and human in ('single_family_office', 'multi_family_office') then 'human_affirmed_fo' when human = 'ria_with_fo_practice' then 'human_ria_fo_practice' when human = 'wealth_manager' then 'human_wealth_manager' else 'human_quarantined' end as bucket from h)"""


def labelled(spark, sf):
    k = F.col("crd")
    human = cases(k % 5, list(enumerate(HUMAN)))
    rows = gated(spark, sf).withColumns({"human_status": F.when(k % 3 < 2, "affirmed").otherwise("rejected"), "human_category": human, "excluded": k % 17 == 0})
    return rows.withColumn("bucket", evaluation.human_bucket(F.col("human_status"), F.col("human_category"), F.col("excluded")))


@query(
    "gate_vs_people",
    f"""with {FIRMS_SQL}, {HUMAN_SQL} select bucket, decision, category, count(*) as n, (bucket = 'human_affirmed_fo' and decision <> 'affirm') or (bucket in ('human_excluded', 'human_wealth_manager') and decision = 'affirm' and category is distinct from 'embedded_fo_practice') as wrong from b group by 1, 2, 3""",
)
def gate_vs_people(spark, sf):
    return evaluation.gate_against_people(labelled(spark, sf))


@query("gate_recall", f"with {FIRMS_SQL}, {HUMAN_SQL} select count(*) as offices, count(*) filter (where decision = 'affirm') as affirmed, count(*) filter (where decision = 'affirm') / count(*) as recall from b where bucket = 'human_affirmed_fo'")
def gate_recall(spark, sf):
    return evaluation.gate_recall(labelled(spark, sf))


@query(
    "band_precision",
    f"""with {FIRMS_SQL}, {HUMAN_SQL}, r as (select not excluded and human in ('single_family_office', 'multi_family_office', 'embedded_fo_practice', 'ria_with_fo_practice') as counted, category in ('single_family_office', 'multi_family_office') as office, status = 'affirmed' and human in ('single_family_office', 'multi_family_office') as proven from b where route in ('client_mix', 'concordant')),
    c as (select count(*) as released, count(*) filter (where counted) as counted, count(*) filter (where office) as offices, count(*) filter (where office and proven) as proven from r) select *, counted / released as counted_precision, proven / offices as strict_precision from c""",
)
def band_precision(spark, sf):
    return evaluation.band_precision(labelled(spark, sf).filter("released"))


@query(
    "reviewed_precision",
    """with v as (select case when toxic is not null and doc_id % 4 > 0 then toxic = 0 end as counted_ok, case when doc_id % 3 > 0 then quality = 1 end as category_ok from labels),
    c as (select count(*) as total, count(counted_ok) as reviewed, count(*) filter (where counted_ok) as counted, count(*) filter (where counted_ok is not null and category_ok is not null) as category_reviewed, count(*) filter (where counted_ok is not null and category_ok) as category, count(*) filter (where not counted_ok or (counted_ok is not null and not category_ok)) as failures from v)
    select *, counted / nullif(reviewed, 0) as counted_precision, category / nullif(category_reviewed, 0) as category_precision from c""",
)
def reviewed_precision(spark, sf):
    k = F.col("doc_id")
    return evaluation.reviewed_precision(table(spark, sf, "labels").select(F.when(k % 4 > 0, F.col("toxic") == 0).alias("counted_ok"), F.when(k % 3 > 0, F.col("quality") == 1).alias("category_ok")))


@query(
    "case_rates",
    """with c as (select count(*) as cases, count(*) filter (where item_id % 5 > 0) as grounded, count(*) filter (where length(text) % 2 = 0 and item_id % 7 > 0) as expected, count(*) filter (where item_id % 5 = 1) as repaired, count(*) filter (where not (item_id % 5 > 0 and length(text) % 2 = 0 and item_id % 7 > 0)) as failures from benchmark)
    select *, grounded / cases as grounded_rate, expected / cases as expectation_rate from c""",
)
def case_rates(spark, sf):
    k = F.col("item_id")
    return evaluation.case_rates(table(spark, sf, "benchmark").select((k % 5 > 0).alias("grounded"), F.when(k % 7 > 0, F.length("text") % 2 == 0).alias("expected"), (k % 5 == 1).alias("repaired")))
