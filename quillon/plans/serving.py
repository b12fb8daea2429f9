"""Queries of what may be served."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import places
from quillon.operators import serving
from quillon.plans.records import FIRMS_SQL, GRADE_SQL, reachable, records, table
from quillon.registry import query

HIGH = 200_000_000


def served(spark, sf):
    return records(spark, sf).withColumns({"aum_usd": F.col("raum"), "city": F.col("segment")})


@query("serve_filtered", f"with {FIRMS_SQL} select crd, name, raum as aum_usd from records where release_state = 'qualifying' and upper(state) = 'NATION_3' and raum >= {HIGH}")
def serve_filtered(spark, sf):
    return serving.constrained(served(spark, sf), state="nation_3", least=HIGH, most=0).select("crd", "name", "aum_usd")


@query("serve_geo_band", f"with {FIRMS_SQL} select crd, segment as city, raum as aum_usd from records where release_state = 'qualifying' and upper(segment) = 'BUILDING' and raum <= {HIGH}")
def serve_geo_band(spark, sf):
    return serving.constrained(served(spark, sf), city="Building", most=HIGH).select("crd", "city", "aum_usd")


@query("record_columns", f"with {FIRMS_SQL} select crd, upper(state) as state, count(*) over () as n from records where release_state = 'qualifying'")
def record_columns(spark, sf):
    view = serving.record_view(serving.qualifying(served(spark, sf)))
    if view.columns != serving.RECORD_COLUMNS:
        raise AssertionError("a served record has its columns in order")
    return view.select("crd", F.upper("state").alias("state")).withColumn("n", view.agg(F.count("*")).scalar())


def signals(spark, sf):
    """Events read as dated signals of the firm of that number."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf, "events").select(F.col("user_id").alias("crd"), F.col("event_type").alias("type"), day.alias("date"), F.concat(F.lit("event "), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("description"))


SIGNALS_SQL = "s as (select user_id as crd, strftime(ts, '%Y-%m-%d') as date, event_type as type, 'event ' || lpad(event_id::varchar, 12, '0') as description from events)"


@query(
    "hydrate_signals",
    f"""with {FIRMS_SQL}, {SIGNALS_SQL}, a as (select crd, list(date || ' ' || type || ' ' || description order by date desc, type desc, description desc) as all_signals from s group by 1)
    select r.crd, r.name, release_basis, coalesce(len(all_signals), 0)::int as n_signals, coalesce(all_signals[1:3], []) as newest from embeddings join records r on r.crd = vec_id left join a on a.crd = r.crd where release_state = 'qualifying'""",
)
def hydrate_signals(spark, sf):
    hits = table(spark, sf, "embeddings").select(F.col("vec_id").alias("crd"))
    full = serving.hydrated(hits, records(spark, sf), signals(spark, sf))
    newest = F.transform(F.slice("signals", 1, 3), lambda s: F.concat_ws(" ", s["date"], s["type"], s["description"]))
    return full.select("crd", "name", "release_basis", F.size("signals").alias("n_signals"), newest.alias("newest"))


@query(
    "slim_records",
    f"""with {FIRMS_SQL} select crd, '{{' || array_to_string(list_filter(['"crd":' || crd, '"name":"' || name || '"', '"domain":"' || domain || '"', '"site":"' || nullif(site, '') || '"', '"raum":' || raum, '"category":"' || final_category || '"',
      case when crd % 2 = 0 then '"sectors":["energy"]' end], lambda x: x is not null), ',') || '}}' as body from records""",
)
def slim_records(spark, sf):
    sectors = F.when(F.col("crd") % 2 == 0, F.array(F.lit("energy"))).otherwise(F.array().cast("array<string>"))
    columns = {"crd": F.col("crd"), "name": F.col("name"), "domain": F.col("domain"), "site": F.coalesce("site", F.lit("")), "raum": F.col("raum"), "category": F.col("final_category"), "sectors": sectors}
    return records(spark, sf).select("crd", serving.slim(columns).alias("body"))


@query(
    "source_cards",
    f"""with {FIRMS_SQL}, h as (select crd, state as query, {GRADE_SQL} as g, (crd * 7) % 100 as score, raum, segment, final_category as c from records where release_state = 'qualifying'),
    n as (select *, row_number() over (partition by query order by case when c in ('single_family_office', 'multi_family_office') then 0 else 1 end, case g when 'PUB' then 0 when 'A' then 1 when 'B' then 2 when 'C' then 3 else 9 end, score desc, crd) as nth from h)
    select query, nth, crd, segment || ', ' || query as location, case when raum >= 1000000000 then printf('$%.1fB', raum / 1e9) when raum >= 1000000 then printf('$%.1fM', raum / 1e6) when raum > 0 then '$' || raum end as aum,
      coalesce(c in ('single_family_office', 'multi_family_office'), false) as is_family_office from n""",
)
def source_cards(spark, sf):
    r = serving.qualifying(reachable(spark, sf))
    hits = r.select("crd", F.col("state").alias("query"), "state", F.col("segment").alias("city"), F.col("raum").alias("aum_usd"), F.col("grade").alias("primary_email_grade"), F.col("final_category").alias("entity_category"), (F.col("crd") * 7 % 100).alias("score"))
    return serving.source_cards(hits).select("query", "nth", "crd", "location", "aum", "is_family_office")


@query(
    "withheld_summary",
    f"with {FIRMS_SQL} select release_state, final_category as category, count(*) as n, list(name order by name, crd)[1:10] as firms from records where release_state <> 'qualifying' group by 1, 2",
)
def withheld_summary(spark, sf):
    return serving.withheld(records(spark, sf).select("crd", "name", "release_state", F.col("final_category").alias("category")))


@query(
    "record_prompt",
    f"""with {FIRMS_SQL}, x as (select *, {GRADE_SQL} as g, case when crd % 4 = 1 then 1900 + crd % 100 end as founded, case when crd % 3 = 0 then 'P' || crd end as contact, case when crd % 6 < 3 then 'p' || crd || '@example.com' end as e from records where release_state = 'qualifying')
    select crd, concat_ws(chr(10), name || ' (' || coalesce(nullif(concat_ws(' | ', state, 'founded ' || founded, 'AUM ' || case when raum >= 1000000000 then printf('$%.1fB', raum / 1e9) when raum >= 1000000 then printf('$%.1fM', raum / 1e6) when raum > 0 then '$' || raum end), ''), 'details n/a') || ')',
      'Entity type: ' || case final_category when 'multi_family_office' then 'multi-family office' when 'single_family_office' then 'single-family office' when 'embedded_fo_practice' then 'advisory firm with an evidenced family-office practice (qualifying, but not a standalone family office)' end,
      case when release_basis = 'gate_released' then 'Release basis: established by the automated inclusion gate; NO decision-maker has been proven for this firm' end,
      case when crd % 5 = 0 then 'TRUST FLAG (evidence changed since we recorded this): site is dark' end, 'About: ' || profile,
      'Primary contact: ' || contact || ' (principal)' || coalesce(' -- ' || e || ' [grade ' || g || ': ' || case g when 'PUB' then 'published by the firm for this person' when 'A' then 'vendor-reported deliverable for an inferred address (not proven to be this person''s mailbox)' when 'B' then 'plausible inference on a catch-all domain, unconfirmable' else 'ungraded' end || ']', '')) as prompt from x""",
)
def record_prompt(spark, sf):
    k, text = F.col("crd"), F.col("crd").cast("string")
    none = F.lit(None).cast("string")
    parts = {
        "name": F.col("name"), "city": none, "state": F.col("state"), "country": none, "founded_year": F.when(k % 4 == 1, 1900 + k % 100), "aum_usd": F.col("raum"), "category": F.col("final_category"), "basis": F.col("release_basis"),
        "trust_state": F.when(k % 5 == 0, "flagged").otherwise("current"), "trust_reason": F.lit("site is dark"), "description": F.col("profile"), "contact": F.when(k % 3 == 0, F.concat(F.lit("P"), text)), "title": none,
        "email": F.when(k % 6 < 3, F.concat(F.lit("p"), text, F.lit("@example.com"))), "grade": F.col("grade"),
    }
    return serving.qualifying(reachable(spark, sf)).select("crd", serving.prompt_lines(parts).alias("prompt"))


@query(
    "allowed_addresses",
    f"""with {FIRMS_SQL}, e as (select state as query, lower(unnest([case when crd % 2 = 0 then 'P' || crd || '@example.com' end, case when crd % 3 = 0 then 's' || (crd % 5) || '@example.com' end, ''])) as e from records where release_state = 'qualifying')
    select query, coalesce(string_agg(distinct e, ', ' order by e) filter (where e <> ''), 'none') as addresses from e group by 1""",
)
def allowed_addresses(spark, sf):
    k = F.col("crd")
    one, two = F.when(k % 2 == 0, F.concat(F.lit("P"), k.cast("string"), F.lit("@example.com"))), F.when(k % 3 == 0, F.concat(F.lit("s"), (k % 5).cast("string"), F.lit("@example.com"))).otherwise("")
    return serving.allowed_addresses(serving.qualifying(records(spark, sf)).select(F.col("state").alias("query"), one.alias("primary_contact_email"), two.alias("secondary_contact_email")))


@query("tool_search", f"with {FIRMS_SQL} select crd, raum as aum_usd, count(*) over () as total from records where release_state = 'qualifying' and lower(free_text) like '%tax%' order by raum desc nulls last, crd limit 25")
def tool_search(spark, sf):
    found = served(spark, sf).withColumn("sectors", F.col("free_text"))
    return serving.structured_search(found, n=100, sector="Tax").select("crd", "aum_usd", "total")


@query("tool_get_record", f"with {FIRMS_SQL} select crd, name from records where release_state = 'qualifying' and contains(lower(name), '00001') order by name, crd limit 3")
def tool_get_record(spark, sf):
    return serving.get_record(records(spark, sf), " 00001 ").select("crd", "name")


_NAMES = " ".join(f"when '{c}' then '{n}'" for c, n in places.STATES.items())


@query("state_names", f"with x as (select c_custkey as key, case when c_custkey % 4 = 0 then 'zz' else lower((['ny', 'ca', 'tx', 'dc', 'wv'])[c_custkey % 5 + 1]) end as code from customer) select key, coalesce(case upper(code) {_NAMES} end, code) as name, case when code not in ('zz', 'dc') then upper(code) end as back from x")
def state_names(spark, sf):
    k = F.col("c_custkey")
    code = F.when(k % 4 == 0, "zz").otherwise(F.element_at(F.array(*map(F.lit, ["ny", "ca", "tx", "dc", "wv"])), (k % 5 + 1).cast("int")))
    named = table(spark, sf, "customer").select(k.alias("key"), places.state_name(code).alias("name"))
    return named.select("key", "name", places.state_code(F.col("name")).alias("back"))
