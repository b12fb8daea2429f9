"""Queries of loaders: decisions, contacts, signals, exclusions, sheets, ledger rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import dates, text
from quillon.operators import keyed, loading
from quillon.operators.release import suppressed
from quillon.operators.storage import shared_path
from quillon.plans.records import FIRMS_SQL, cases, records, table
from quillon.registry import query

STATUS = ["affirmed", "rejected", "unresolved"]
CATEGORIES = ["single_family_office", "wealth_manager", "bank"]


@query(
    "ratification_load",
    """with d as (select c_custkey as key, (['affirmed', 'rejected', 'unresolved'])[c_custkey % 3 + 1] as status, case when c_custkey % 11 < 10 then (['single_family_office', 'wealth_manager', 'bank'])[(c_custkey // 3) % 3 + 1] end as category,
      c_custkey % 5 = 0 as by_nobody, c_custkey % 7 = 0 as unsaid, list_distinct([case when c_custkey % 2 = 0 then 'registry' else 'site' end, case when c_custkey % 4 < 2 then 'registry' else 'press' end]) as classes from customer),
    o as (select *, case when by_nobody or unsaid or category is null or category = 'bank' then 'refused' when status = 'affirmed' and len(classes) < 2 then 'demoted' else 'applied' end as outcome from d)
    select key, outcome, case outcome when 'applied' then status when 'demoted' then 'unresolved' end as status, case outcome when 'applied' then category when 'demoted' then 'unresolved' end as category from o""",
)
def ratification_load(spark, sf):
    k = F.col("c_custkey")
    third = F.floor(k / 3) % 3
    category = F.when(k % 11 < 10, cases(third, list(enumerate(CATEGORIES))))
    classes = F.array(F.when(k % 2 == 0, "registry").otherwise("site"), F.when(k % 4 < 2, "registry").otherwise("press"))
    decisions = table(spark, sf, "customer").select(k.alias("key"), cases(k % 3, list(enumerate(STATUS))).alias("status"), category.alias("category"), F.when(k % 5 == 0, " ").otherwise("ann").alias("decided_by"), F.when(k % 7 > 0, "because").alias("rationale"), classes.alias("classes"))
    return loading.ratified(loading.through_json(decisions, "decisions")).select("key", "outcome", "status", "category")


@query(
    "contacts_load",
    """with o as (select o_custkey as key, case when o_orderkey % 2 = 0 then 'primary' else 'secondary' end as role, o_orderkey as n, o_orderkey % 4 = 1 as published from orders where o_orderkey % 6 <> 0)
    select key, role, n, published from o qualify row_number() over (partition by key, role order by n desc) = 1""",
)
def contacts_load(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.when(k % 2 == 0, "primary").otherwise("secondary").alias("role"), k.alias("n"), F.when(k % 6 > 0, "ann").otherwise("").alias("decided_by"), F.when(k % 4 == 1, "x@example.com").alias("published_email"))
    return loading.ratified_contacts(rows).select("key", "role", "n", "published")


@query("signals_reload", "select user_id as key, min(strftime(ts, '%Y-%m-%d')) as date, event_type as description from events where event_id % 3 > 0 and event_id % 5 > 0 group by 1, 3")
def signals_reload(spark, sf):
    """Loads twice: the second time replaces the first."""
    k = F.col("event_id")
    rows = table(spark, sf, "events").select(F.col("user_id").alias("key"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_type").alias("description"), F.when(k % 3 > 0, "https://example.com").alias("source_url"), F.when(k % 5 > 0, "ann").alias("decided_by"))
    path = shared_path(spark, "signals")
    kept = loading.ratified_signals(rows).select("key", "date", "description")
    loading.reloaded(kept.limit(7), path)
    return loading.reloaded(kept, path)


@query(
    "company_pages_load",
    "select s_suppkey as key, case when s_suppkey % 3 = 0 then 'https://www.linkedin.com/company/f' || s_suppkey end as linkedin, case when s_suppkey % 3 = 0 then case when s_suppkey % 2 = 0 then 'name' else 'search' end end as linkedin_source from supplier",
)
def company_pages_load(spark, sf):
    k = F.col("s_suppkey")
    url = F.concat(F.lit(" https://www.linkedin.com/"), F.when(k % 3 == 0, "company/f").otherwise("in/f"), k.cast("string"), F.lit("/"))
    found = table(spark, sf, "supplier").filter("s_suppkey % 5 < 5").select(k.alias("key"), url.alias("url"), F.when(k % 2 == 0, "name").otherwise("").alias("matched_on"))
    return loading.company_pages(found, table(spark, sf, "supplier").select(k.alias("key")))


@query("exclusions", "select c_custkey as key, case when c_custkey % 29 = 7 then 'institutional manager' end as reason from customer")
def exclusions(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    listed = rows.filter("key % 29 = 7").withColumn("reason", F.lit("institutional manager"))
    kept, out = loading.split_excluded(rows, listed)
    return kept.withColumn("reason", F.lit(None).cast("string")).unionByName(out)


@query(
    "review_sheets",
    """with p as (select o_custkey as key, 'P' || lpad(o_orderkey::varchar, 9, '0') as person from orders), n as (select key, person, row_number() over (partition by key order by person) as n from p),
    e as (select key, string_agg('{"person":"' || person || '","title":"Partner","spans":["a","b","c"]}', ',' order by n) filter (where n <= 10) as people from n group by 1)
    select c_custkey as key, '{"key":' || c_custkey || ',"name":"' || c_name || '",' || case c_custkey % 3 when 0 then '"category":"multi_family_office","expected":"CIO / head of investments (or the founding principal if small)"' else '"expected":"unknown"' end
      || ',"people":[' || coalesce(people, '') || '],"decided_by":""}' as sheet from customer left join e on key = c_custkey""",
)
def review_sheets(spark, sf):
    k = F.col("c_custkey")
    firms = table(spark, sf, "customer").select(k.alias("key"), F.col("c_name").alias("name"), F.when(k % 3 == 0, "multi_family_office").alias("category"))
    people = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.concat(F.lit("P"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("person"), F.lit("Partner").alias("title"), F.array(*map(F.lit, "abcd")).alias("spans"))
    return loading.through_json(loading.review_sheet(firms, people), "sheets")


@query("candidates_jsonl", f"with {FIRMS_SQL} select crd, name, case when by_name then 'strong' when text then 'strong_text' end as tier from g1 where by_name or text")
def candidates_jsonl(spark, sf):
    from quillon.functions import rules
    from quillon.plans.records import firms

    tier = rules.discovery_tier(F.col("name"), F.col("free_text"), F.lit(None).cast("double"), F.lit(0))
    found = firms(spark, sf).select("crd", "name", tier.alias("tier")).filter(F.col("tier").isin("strong", "strong_text"))
    return loading.through_json(found, "candidates")


@query(
    "ledger_append",
    """select * from (select event_id as run_id, 'observe' as phase, event_type as event, 'ok' as status, null::bigint as tokens, null::bigint as micros from events
    union all select o_orderkey, 'answer', 'model', case when o_orderstatus = 'F' then 'ok' else 'error' end, o_orderkey % 100, null from orders)""",
)
def ledger_append(spark, sf):
    one = table(spark, sf, "events").select(F.col("event_id").alias("run_id"), F.lit("observe").alias("phase"), F.col("event_type").alias("event"), F.lit("ok").alias("status"))
    two = table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"), F.lit("answer").alias("phase"), F.lit("model").alias("event"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("error").alias("status"), (F.col("o_orderkey") % 100).alias("tokens"))
    return loading.at_version(loading.appended(loading.at_version(one, "run_events", 1), two), "run_events")


@query(
    "decision_batches",
    "select 'crd:' || s_suppkey as key, r as role, 'P' || r as name, case when r = 'primary' then 'CIO' end as title, 'page ' || s_suppkey as authority from supplier, (values ('primary'), ('secondary')) v(r) where r = 'primary' or s_suppkey % 3 = 0",
)
def decision_batches(spark, sf):
    k = F.col("s_suppkey")
    evidence = F.create_map(F.lit("authority"), F.concat(F.lit("page "), k.cast("string")))
    one = F.struct(F.lit("Pprimary").alias("name"), F.lit("CIO").alias("title"), evidence.alias("evidence"))
    two = F.struct(F.when(k % 3 == 0, "Psecondary").otherwise(" ").alias("name"), F.lit(None).cast("string").alias("title"), evidence.alias("evidence"))
    path = shared_path(spark, "batches")
    table(spark, sf, "supplier").select(F.to_json(F.struct(F.concat(F.lit("crd:"), k.cast("string")).alias("key"), one.alias("primary"), two.alias("secondary"))).alias("value"), (k % 4).alias("batch")).groupBy("batch").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("\n]")).alias("value")).write.partitionBy("batch").text(path)
    found = loading.decisions_from(spark, f"{path}/*")
    return found.select("key", "role", "name", "title", F.col("evidence")["authority"].alias("authority"))


@query("promotion_scope", f"with {FIRMS_SQL} select crd as key, decision, 'gate-v2' as gate_version, 'band-v1' as band_version from gated where crd in (select s_suppkey from supplier)")
def promotion_scope(spark, sf):
    from quillon.plans.records import gated

    rows = gated(spark, sf).select(F.col("crd").alias("key"), "decision")
    return loading.versioned(loading.scoped(rows, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"))))


@query(
    "stale_flags",
    f"""with {FIRMS_SQL}, x as (select crd, release_state, case crd % 4 when 0 then '2026-02-11' when 1 then '2025-03-31' when 2 then '2025-02-28' end as filed from records)
    select crd, filed as data_asof, case when release_state = 'qualifying' and filed is not null then (2026 - filed[1:4]::int) * 12 + 6 - filed[6:7]::int > 15 end as is_stale from x""",
)
def stale_flags(spark, sf):
    filed = cases(F.col("crd") % 4, [(0, "2026-02-11"), (1, "2025-03-31"), (2, "2025-02-28")])
    months = dates.months_since(filed, F.lit("2026-06-30").cast("date"))
    return records(spark, sf).select("crd", filed.alias("data_asof"), loading.stale(F.col("release_state"), months).alias("is_stale"))


@query(
    "facts_compared",
    """select c_custkey as key, list_filter([case when c_custkey % 4 = 0 then 'fund' end, case when c_custkey % 3 = 0 then 'roster' end, case when c_custkey % 5 > 0 then 'thesis' end], lambda x: x is not null) as changed,
      case when c_custkey % 2 = 0 then case when c_custkey % 3 = 0 then 'Bo' else 'Ann' end else case when c_custkey % 5 > 0 then 'new' end end as value,
      c_custkey % 3 = 0 and c_custkey % 7 > 0 as maker_gone from customer""",
)
def facts_compared(spark, sf):
    k = F.col("key")
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    none = F.lit(None).cast("string")
    old = F.create_map(F.lit("roster"), F.lit("Ann"), F.lit("thesis"), none)
    new = F.map_concat(F.create_map(F.lit("roster"), F.when(k % 3 == 0, "Bo").otherwise("Ann")), F.create_map(F.lit("thesis"), F.when(k % 5 > 0, "new")), F.create_map(F.lit("fund"), F.when(k % 4 == 0, "II")))
    confirmed = F.when(k % 7 > 0, F.array(F.lit("roster_gone"))).otherwise(F.array(F.lit("title")))
    gone = loading.maker_gone(confirmed, F.lit(" Ann"), F.array(new["roster"]))
    field = F.when(k % 2 == 0, "roster_added").otherwise("thesis")
    return base.select("key", loading.changed_facts(old, new).alias("changed"), loading.fact_value(new, field).alias("value"), gone.alias("maker_gone"))


@query("contact_suppression", f"with {FIRMS_SQL} select crd, case when person_status = 'proven' then name end as contact_name, case when person_status = 'proven' then domain end as contact_domain, state from records")
def contact_suppression(spark, sf):
    rows = records(spark, sf).select("crd", F.col("name").alias("contact_name"), F.col("domain").alias("contact_domain"), "state", "person_status")
    return suppressed(rows, ["contact_name", "contact_domain"], F.col("person_status") == "proven").drop("person_status")


@query(
    "text_keys",
    """with x as (select c_custkey as key, '+1 (555) 010-' || lpad((c_custkey % 10000)::varchar, 4, '0') as phone, case when c_custkey % 5 = 0 then '13/40/2026' else (1 + c_custkey % 12) || '/' || (1 + c_custkey % 28) || '/2026' end as day, c_name || ' & Co., ' || c_mktsegment as name from customer)
    select key, case when key % 3 > 0 then right(regexp_replace(phone, '[^0-9]', '', 'g'), 10) end as phone, case when key % 5 > 0 then '2026-' || lpad((1 + key % 12)::varchar, 2, '0') || '-' || lpad((1 + key % 28)::varchar, 2, '0') end as day, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) as folded from x""",
)
def text_keys(spark, sf):
    k = F.col("c_custkey")
    phone = F.when(k % 3 > 0, F.concat(F.lit("+1 (555) 010-"), F.lpad((k % 10000).cast("string"), 4, "0"))).otherwise("010-1")
    day = F.when(k % 5 == 0, "13/40/2026").otherwise(F.concat_ws("/", 1 + k % 12, 1 + k % 28, F.lit("2026")))
    name = F.concat("c_name", F.lit(" & Co., "), "c_mktsegment")
    return table(spark, sf, "customer").select(k.alias("key"), text.phone_digits(phone).alias("phone"), dates.iso_date(day).alias("day"), text.fold(name).alias("folded"))


@query(
    "roster_refresh",
    """with f as (select o_orderkey as person, o_custkey as key, o_orderstatus as title from orders where o_custkey % 4 > 0), h as (select c_custkey as key, 'A' as grade from customer where c_custkey % 3 = 0)
    select person, f.key, title, grade from f left join h using (key) where f.key in (select s_suppkey from supplier)""",
)
def roster_refresh(spark, sf):
    """A fresh roster keeps the grades that were verified before, and nobody whose firm is gone."""
    fresh = table(spark, sf, "orders").filter("o_custkey % 4 > 0").select(F.col("o_orderkey").alias("person"), F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("title"))
    held = table(spark, sf, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("key"), F.lit("A").alias("grade"))
    firms = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"))
    return keyed.keep_children(keyed.preserve(fresh, held, ["key"], ["grade"]), firms, ["key"])
