"""Queries of review and of the gate over composed answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.operators import review
from quillon.plans.records import cases, table
from quillon.registry import query

TEXTS = ["Founder Ann Lee started in 1998. We serve one family in energy and real estate.", "A multi-family office. CIO Bo Ray, Analyst Cy Dow.", "Family office services by a registered investment advisor since 2011.", "Nothing."]


def _text(k):
    return cases(k % 4, list(enumerate(TEXTS)))


@query(
    "extract_mock",
    """select s_suppkey as key, case s_suppkey % 4 when 0 then ['real estate', 'energy'] else [] end as sectors, case s_suppkey % 4 when 0 then 1998 when 2 then 2011 end as founded_year,
    case s_suppkey % 4 when 0 then ['Ann Lee'] when 1 then ['Bo Ray', 'Cy Dow'] else [] end as names, case s_suppkey % 4 when 0 then 1 when 1 then 1 else 0 end as principals from supplier""",
)
def extract_mock(spark, sf):
    parts = review.extracted(_text(F.col("s_suppkey")))
    got = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), *(v.alias(k) for k, v in parts.items()))
    return got.select("key", "sectors", "founded_year", F.transform("team", lambda m: m["name"]).alias("names"), F.size(F.filter("team", lambda m: m["is_principal"])).alias("principals"))


@query(
    "category_draft",
    """with t as (select c_custkey as key, c_custkey % 4 as k, c_custkey % 12 as hnw, (c_custkey % 3) * 60 as other from customer)
    select key, case k when 0 then 'single_family_office' when 1 then case when hnw + other > 100 then 'wealth_manager' else 'multi_family_office' end when 2 then 'ria_with_fo_practice' else 'unresolved' end as category,
      case k when 0 then case when hnw + other > 5 then 'clients contradict one family' else 'clients consistent' end when 1 then case when hnw + other > 100 then 'retail-scale book' else 'self-described' end when 2 then 'self-described'
        else case when hnw + other > 0 and hnw + other <= 10 and hnw >= other then 'one class of evidence only' else 'no self-description' end end as note from t""",
)
def category_draft(spark, sf):
    k = F.col("c_custkey")
    category, note = review.draft_category(_text(k), k % 12, (k % 3) * 60)
    return table(spark, sf, "customer").select(k.alias("key"), category.alias("category"), note.alias("note"))


@query(
    "authority_mentions",
    """select * from (select s_suppkey as key, unnest(['Ann Lee', 'Ann Lee', 'Bo Ray', 'Cy Dow']) as name, unnest(['Ann Lee manages the portfolio.', 'Ann Lee, Bo Ray, Cy Dow: investment committee.', 'Ann Lee, Bo Ray, Cy Dow: investment committee.', 'Ann Lee, Bo Ray, Cy Dow: investment committee.']) as span,
      unnest([true, false, false, false]) as authority, unnest([false, true, true, true]) as roster from supplier)""",
)
def authority_mentions(spark, sf):
    key = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"))
    people = key.select("key", F.explode(F.array(*map(F.lit, ["Ann Lee", "Bo Ray", "Cy Dow"]))).alias("name"))
    return review.mentions(key.withColumn("text", F.lit("Ann Lee manages the portfolio.  Ann Lee, Bo Ray, Cy Dow: investment\ncommittee. We grow.")), people)


@query(
    "reviewer_notes",
    """select c_custkey as key, concat_ws(' | ', case when c_custkey % 3 = 0 then 'no passage names this person' when c_custkey % 3 = 1 then 'no mention states authority' else 'authority stated; read the span' end,
      case when c_custkey % 5 = 0 then 'title is not an investment role' end, case when c_custkey % 5 = 1 and c_custkey % 2 = 0 then 'firm-level leader at an embedded practice' end, case when c_custkey % 7 <= 2 then 'very small staff' end, case when c_custkey % 4 = 0 then 'no published address' end) as note from customer""",
)
def reviewer_notes(spark, sf):
    k = F.col("c_custkey")
    title = cases(k % 5, [(0, "Head of Compliance"), (1, "Founder")], "Principal")
    note = review.reviewer_note(k % 3, F.when(k % 3 == 2, 1).otherwise(0), title, F.when(k % 2 == 0, "embedded_fo_practice"), k % 7, F.when(k % 4 != 0, "a@example.org"))
    return table(spark, sf, "customer").select(k.alias("key"), note.alias("note"))


@query("name_resolution", "select * from (values ('supplier#000000007', 7), ('000000005', 5), ('Supplier#0000', null), ('The Supplier#000000009 Group', 9)) t(name, key)")
def name_resolution(spark, sf):
    asked = spark.createDataFrame([(n,) for n in ("supplier#000000007", "000000005", "Supplier#0000", "The Supplier#000000009 Group", "Nobody")], "name string")
    return review.resolved_names(asked, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("held")))


@query(
    "answer_gate",
    """with p as (select c_custkey as k from customer) select 'firm ' || k as firm, list_filter([case when k % 11 = 0 then 'not_a_record' end, case when k % 11 <> 0 and k % 3 = 0 then 'not_releasable' end, case when k % 11 <> 0 and k % 5 = 0 then 'email_not_on_record' end,
      case when k % 11 <> 0 and k % 4 = 0 and k % 7 < 4 then 'confidence_above_evidence' end, case when k % 11 <> 0 and k % 4 = 1 and k % 7 < 2 then 'strong_over_weak' end], lambda x: x is not null) as failures from p""",
)
def answer_gate(spark, sf):
    k = F.col("c_custkey")
    text = F.concat(F.lit("Write to A"), k.cast("string"), F.when(k % 5 == 0, "x").otherwise(""), F.lit("@example.org. Fine."))
    picks = table(spark, sf, "customer").select(F.concat(F.lit("firm "), k.cast("string")).alias("firm"), k.alias("key"), F.when(k % 7 < 2, "strong").when(k % 7 < 4, "moderate").otherwise("weak").alias("confidence"), text.alias("text"))
    records = table(spark, sf, "customer").filter("c_custkey % 11 <> 0").select(k.alias("key"), (k % 3 != 0).alias("pickable"), F.array(F.concat(F.lit("a"), k.cast("string"), F.lit("@example.org"))).alias("emails"), cases(k % 4, [(0, "insufficient_evidence"), (1, "weak")], "strong").alias("tier"))
    return review.pick_failures(picks, records)


@query("recommendation_check", "select s_suppkey as key, s_suppkey % 4 in (0, 3) as pushes from supplier")
def recommendation_check(spark, sf):
    k, pad = F.col("s_suppkey"), "x" * 200
    far = f"we suggest patience {pad} Hidden Partners is held {pad}"
    text = cases(k % 4, [(0, f"{pad} we suggest Hidden Partners now {pad}"), (1, far), (3, f"{far} and Hidden Partners is worth a look")], "Hidden Partners is on file; contact Ada")
    name = F.when(k % 4 == 2, "Ada").otherwise("Hidden Partners")
    return table(spark, sf, "supplier").select(k.alias("key"), review.recommends(text, name).alias("pushes"))


@query("place_constraints", "select c_custkey as id, p as place from customer, (values ('Chicago', 0), ('Boston', 1), ('Chicago', 2), ('Boston', 2), ('New York', 3), ('St. Louis', 3)) v(p, k) where c_custkey % 5 = k")
def place_constraints(spark, sf):
    k = F.col("c_custkey")
    said = [(0, "Offices out of Chicago, IN."), (1, "In BOSTON?"), (2, "Chicago or Boston"), (3, "new  york, or St Louis")]
    goals = table(spark, sf, "customer").select(k.alias("id"), cases(k % 5, said, "Chicagoland, Yorkshire new and Ada").alias("text"))
    return review.stated_places(goals, spark.createDataFrame([(p,) for p in ("Chicago", "Boston", "Ada", "New York", "St. Louis")], "place string"))


@query(
    "record_prose",
    """select c_custkey as key, c_name || ' is a ' || case when c_custkey % 2 = 0 then 'family office' else 'wealth manager' end || coalesce(' based in ' || n_name, '') || case when c_custkey % 3 = 0 then ', founded ' || (1950 + c_custkey % 50) else '' end || '.'
      || case c_custkey % 4 when 0 then ' Assets: $2.5B.' when 1 then ' Assets: $7.0M.' when 2 then ' Assets: $900.' else '' end || case when c_custkey % 5 = 0 then ' Thesis: patience' else '' end || case when c_custkey % 7 = 0 then ' Sectors: energy, real estate.' else '' end as content
    from customer left join nation on c_nationkey = n_nationkey""",
)
def record_prose(spark, sf):
    k = F.col("c_custkey")
    places = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    content = review.prose(
        F.col("c_name"), F.when(k % 2 == 0, "family office").otherwise("wealth manager"), F.col("n_name"), F.when(k % 3 == 0, 1950 + k % 50), cases(k % 4, [(0, F.lit(2_500_000_000)), (1, F.lit(7_000_000).cast("long")), (2, F.lit(900).cast("long"))]),
        F.when(k % 5 == 0, "patience"), F.when(k % 7 == 0, F.array(F.lit("energy"), F.lit("real estate"))),
    )
    return table(spark, sf, "customer").join(places, "c_nationkey", "left").select(k.alias("key"), content.alias("content"))


@query(
    "registry_compare",
    """with k as (select s_suppkey as key from supplier where s_suppkey % 9 <> 0) select key, list_filter([case when key % 6 <> 0 and key % 2 = 0 then 'filing_moved' end, case when key % 6 <> 0 and key % 5 = 0 and key % 10 <> 0 then 'registration_lapsed' end,
      case when key % 6 <> 0 and key % 7 = 0 then 'name_changed' end, case when key % 6 = 0 and (key % 4 <> 0 or key % 10 = 0) then 'registration_gone' end], lambda x: x is not null) as events from k""",
)
def registry_compare(spark, sf):
    k = F.col("s_suppkey")
    scope = F.when(k % 10 == 0, "LAPSED").when((k % 6 == 0) & (k % 4 == 0), "not_found").otherwise("ACTIVE")
    held = table(spark, sf, "supplier").select(k.alias("key"), F.lit("2025-03-31").alias("filed"), F.col("s_name").alias("name"), scope.alias("scope"))
    live = table(spark, sf, "supplier").filter("s_suppkey % 9 <> 0").select(k.alias("key"), (k % 6 != 0).alias("found"), F.when(k % 2 == 0, "2026-03-31").otherwise("2025-03-31").alias("filed"), F.when(k % 5 == 0, "LAPSED").otherwise("ACTIVE").alias("scope"), F.when(k % 7 == 0, "Other").otherwise(F.lower("s_name")).alias("name"))
    return review.registry_events(held, live)


@query(
    "materiality_verdict",
    """select c_custkey as key, case when c_custkey % 13 = 0 then 'error' when c_custkey % 11 = 0 then 'no_baseline' when c_custkey % 7 = 0 then 'refetch_empty' when c_custkey % 5 = 0 then 'material' when c_custkey % 3 = 0 then 'oscillating' when c_custkey % 2 = 0 then 'unconfirmed' else 'cosmetic' end as verdict from customer""",
)
def materiality_verdict(spark, sf):
    k = F.col("c_custkey")
    n = lambda d: F.when(k % d == 0, 1).otherwise(0)
    return table(spark, sf, "customer").select(k.alias("key"), review.materiality(k % 13 == 0, k % 11 != 0, F.when(k % 7 == 0, 0).otherwise(3), n(5), n(3), n(2)).alias("verdict"))


@query("call_dedupe", "select user_id as session, min(event_id) as step, event_type as name, (props->>'$.k')::int % 10 as args from events group by user_id, event_type, (props->>'$.k')::int % 10")
def call_dedupe(spark, sf):
    calls = table(spark, sf, "events").select(F.col("user_id").alias("session"), F.col("event_id").alias("step"), F.col("event_type").alias("name"), (F.get_json_object("props", "$.k").cast("int") % 10).alias("args"))
    return review.first_calls(calls)


@query("detail_merge", "select s_suppkey as key, case when s_suppkey % 3 = 0 then ['a=1', 'b=2'] when s_suppkey % 3 = 1 then ['a=1', 'b=9', 'c=3'] else ['b=9', 'c=3'] end as detail from supplier")
def detail_merge(spark, sf):
    key = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"))
    pairs = lambda *kv: F.create_map(*map(F.lit, kv))
    merged = review.merged_details(key.filter("key % 3 <> 2").withColumn("detail", pairs("a", "1", "b", "2")), key.filter("key % 3 <> 0").withColumn("detail", pairs("b", "9", "c", "3")))
    return merged.select("key", F.array_sort(F.transform(F.map_entries("detail"), lambda e: F.concat_ws("=", e["key"], e["value"]))).alias("detail"))
