"""Queries over firm records. The test tables stand in for a registry: a customer is a firm, its orders are its clients."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import rules
from quillon.functions.plan import once
from quillon.operators import contacts, keyed, release
from quillon.registry import query

FIRMS_SQL = """
o as (select o_custkey, sum(round(o_totalprice * 100)::bigint)::bigint as raum, sum(case when o_orderpriority in ('1-URGENT', '2-HIGH') then round(o_totalprice * 100)::bigint else 0 end)::bigint as hnw_raum,
  count(*) filter (where o_orderpriority in ('1-URGENT', '2-HIGH')) as hnw, count(*) filter (where o_orderpriority not in ('1-URGENT', '2-HIGH')) as other from orders group by 1),
firms as (
  select c_custkey as crd, c_name || ' ' || case c_custkey % 7 when 0 then 'Family Office' when 1 then 'Family Capital' when 2 then 'Multi-Family Offices' when 3 then 'MFO Partners' when 4 then 'Single Family Office LLC' else 'Wealth Advisors' end as name,
    n_name as state, raum, case when c_custkey % 3 = 0 then raum else hnw_raum end as hnw_raum, hnw, case when c_custkey % 13 = 0 then 101 else other end as other,
    (case when c_custkey % 17 = 0 then 200 else c_custkey % 90 end)::int as employees,
    case when c_custkey % 5 in (0, 1) then 'We are a family office. Our family office services team serves one family office.' when c_custkey % 5 = 2 then 'A family office.' when c_custkey % 5 = 3 then 'Advice for all.' end as site,
    c_custkey % 19 = 0 as fo_page, case when c_custkey % 4 = 0 then 'Other: family  office services' when c_custkey % 4 = 1 then 'Tax advice' end as free_text,
    case when c_custkey % 11 = 0 then 'the-family-office.example.com' when c_custkey % 11 < 6 then 'firm' || c_custkey || '.example.com' end as domain,
    case when c_custkey % 6 = 0 then 'serves families across generations' when c_custkey % 6 = 1 then 'serves institutions' end as profile,
    c_mktsegment as segment, c_acctbal as balance
  from customer left join nation on c_nationkey = n_nationkey left join o on o_custkey = c_custkey),
g0 as (select *, regexp_matches(name, '(?i)\\b((multi[\\s-]?|single[\\s-]?)?family\\s+offices?)\\b') as by_name, regexp_matches(coalesce(site, ''), '(?i)family[\\s-]+office\\s+(services?|practice|group|division|team|solutions)') or fo_page as practice,
  regexp_matches(coalesce(free_text, ''), '(?i)family\\s+office') as text, len(regexp_extract_all(coalesce(site, ''), '(?i)family[\\s-]+office')) >= 2 as selfdesc, coalesce(hnw, 0) + coalesce(other, 0) as clients,
  case when coalesce(raum, 0) <> 0 then coalesce(hnw_raum, 0)::double / raum::double end as share, coalesce(domain, '') like '%familyoffice%' or replace(coalesce(domain, ''), '-', '') like '%familyoffice%' as by_domain,
  coalesce(raum, 0) > 15000000000 or employees > 150 as inst, coalesce(other, 0) > 100 as retail from firms),
g1 as (select *, coalesce(raum, 0) <> 0 and coalesce(share, 0) >= 0.75 and clients > 0 and clients <= 15 as shape, regexp_matches(coalesce(profile, ''), '(?i)\\bfamil(y|ies)\\b') and (practice or by_name or text) as by_profile from g0),
g2 as (select *, (40 * by_name::int + 25 * practice::int + 20 * selfdesc::int + 15 * text::int + 20 * shape::int + 10 * by_domain::int + 10 * by_profile::int - 40 * inst::int - 25 * retail::int)::int as score,
  7 - 7 + by_name::int + practice::int + selfdesc::int + text::int + shape::int + by_domain::int + by_profile::int as n_evidence, inst::int + retail::int as n_against from g1),
g3 as (select *, case when not (practice or selfdesc or by_domain or by_profile) and (by_name or practice or text or selfdesc) and score >= 30 then 'needs_evidence'
    when not (by_name or practice or text or selfdesc) then case when score >= 30 then 'needs_evidence' else 'exclude' end
    when not by_name and practice and text and not inst and score + 25 * retail::int >= 40 then 'affirm_embedded' when score >= 60 then 'affirm' when score >= 30 then 'needs_evidence' else 'exclude' end as d from g2),
gated as (select *, case when d = 'affirm_embedded' then 'affirm' else d end as decision,
    case when d = 'affirm_embedded' then 'embedded_fo_practice' when d = 'affirm' then case when regexp_matches(name, '(?i)\\bsingle[\\s-]?family\\b|\\bone\\s+family\\b') or (by_name and clients > 0 and clients <= 2 and not retail) then 'single_family_office' else 'multi_family_office' end end as category,
    case when d not like 'affirm%' then 'not_affirmed' when share is not null and share >= 0.90 and coalesce(other, 0) <= 15 then 'client_mix' when score >= 100 then 'concordant' when share is null then 'no_mix' else 'mix_inconsistent' end as route from g3),
decided as (select gated.*, case when crd % 8 in (0, 1) then 'affirmed' when crd % 8 = 2 then 'rejected' when crd % 8 = 3 then 'unresolved' end as status,
    case when crd % 8 in (0, 1, 2, 3) then case crd % 5 when 0 then 'single_family_office' when 1 then 'multi_family_office' when 2 then 'embedded_fo_practice' when 3 then 'wealth_manager' else 'not_fo' end end as adj_category,
    case when crd % 24 = 1 then crd - 1 end as duplicate_of, crd % 3 = 0 as has_contact from gated where crd % 29 <> 7),
released as (select *, coalesce(status = 'affirmed' and duplicate_of is null and adj_category in ('single_family_office', 'multi_family_office', 'embedded_fo_practice'), false) as human,
    status is null and decision = 'affirm' and route in ('client_mix', 'concordant') as by_gate from decided),
records as (select *, case when human or by_gate then 'qualifying' when status in ('rejected', 'unresolved') or duplicate_of is not null then 'quarantined' else 'unresolved' end as release_state,
    case when human then 'human_ratified' when by_gate then 'gate_released' end as release_basis, case when human and has_contact then 'proven' when human or by_gate then 'not_established' end as person_status,
    coalesce(adj_category, case when by_gate then category end) as final_category from released)
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cases(column, pairs, default=None):
    """CASE on the value of a column; each key is a value or a list of values."""
    out = F.when(F.lit(False), None)
    for value, then in pairs:
        out = out.when(column.isin(value) if isinstance(value, list) else column == value, then)
    return out if default is None else out.otherwise(default)


def firms(spark: SparkSession, sf: str) -> DataFrame:
    high, cents = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.round(F.col("o_totalprice") * 100).cast("long")
    mix = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(cents).alias("raum"), F.sum(F.when(high, cents).otherwise(0)).alias("hnw"), F.count_if(high).alias("n_hnw"), F.count_if(~high).alias("n_other"))
    places = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
    joined = table(spark, sf, "customer").join(places, "c_nationkey", "left").join(mix.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    k = F.col("c_custkey")
    suffix = cases(k % 7, [(0, "Family Office"), (1, "Family Capital"), (2, "Multi-Family Offices"), (3, "MFO Partners"), (4, "Single Family Office LLC")], "Wealth Advisors")
    site = cases(k % 5, [([0, 1], "We are a family office. Our family office services team serves one family office."), (2, "A family office."), (3, "Advice for all.")])
    domain = F.when(k % 11 == 0, "the-family-office.example.com").when(k % 11 < 6, F.concat(F.lit("firm"), k.cast("string"), F.lit(".example.com")))
    return joined.select(
        k.alias("crd"), F.concat_ws(" ", "c_name", suffix).alias("name"), "state", "raum", F.when(k % 3 == 0, F.col("raum")).otherwise(F.col("hnw")).alias("hnw_raum"), F.col("n_hnw").alias("hnw"),
        F.when(k % 13 == 0, 101).otherwise(F.col("n_other")).alias("other"), F.when(k % 17 == 0, 200).otherwise(k % 90).cast("int").alias("employees"), site.alias("site"), (k % 19 == 0).alias("fo_page"),
        cases(k % 4, [(0, "Other: family  office services"), (1, "Tax advice")]).alias("free_text"), domain.alias("domain"), cases(k % 6, [(0, "serves families across generations"), (1, "serves institutions")]).alias("profile"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
    )


def gated(spark: SparkSession, sf: str) -> DataFrame:
    scored = rules.gate(firms(spark, sf))
    return once(scored, rules.release_band(F.col("decision"), F.col("score"), F.col("share"), F.col("other")))


def records(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("crd")
    status = cases(k % 8, [([0, 1], "affirmed"), (2, "rejected"), (3, "unresolved")])
    human = F.when(k % 8 < 4, cases(k % 5, [(0, "single_family_office"), (1, "multi_family_office"), (2, "embedded_fo_practice"), (3, "wealth_manager")], "not_fo"))
    decided = gated(spark, sf).filter(k % 29 != 7).withColumns({"status": status, "adj_category": human, "duplicate_of": F.when(k % 24 == 1, k - 1), "has_contact": k % 3 == 0})
    ways = release.precedence(F.col("status"), F.col("adj_category"), F.col("duplicate_of"), F.col("has_contact"), F.col("decision") == "affirm", F.col("released"))
    kept = once(decided, ways)
    return kept.withColumn("final_category", F.coalesce("adj_category", F.when(F.col("release_basis") == "gate_released", F.col("category"))))


@query("filters_total_topn", "select c_custkey, c_name, n_name as state, c_acctbal, count(*) over () as total from customer join nation on c_nationkey = n_nationkey where n_name = 'NATION_3' and c_acctbal >= 1000 order by c_acctbal desc nulls last, c_custkey limit 15")
def filters_total_topn(spark, sf):
    places = table(spark, sf, "nation").filter(F.upper("n_name") == "NATION_3").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
    found = table(spark, sf, "customer").filter("c_acctbal >= 1000").join(places, "c_nationkey").select("c_custkey", "c_name", "state", "c_acctbal")
    return keyed.with_total(found, 15, F.desc_nulls_last("c_acctbal"), F.asc("c_custkey"))


@query("name_lookup", "select c_custkey, c_name, c_mktsegment from customer where c_name ilike '%#00000012%' or c_mktsegment ilike '%house%' order by c_acctbal desc, c_custkey limit 10")
def name_lookup(spark, sf):
    hit = F.ilike("c_name", F.lit("%#00000012%")) | F.ilike("c_mktsegment", F.lit("%house%"))
    return keyed.top(table(spark, sf, "customer").filter(hit), 10, F.desc("c_acctbal"), F.asc("c_custkey")).select("c_custkey", "c_name", "c_mktsegment")


@query("sector_keyword_any", "select p_partkey, string_split(p_name, ' ') as sectors from part where len(list_filter(string_split(p_name, ' '), lambda s: s ilike '%ring%')) > 0 or p_type ilike '%promo%'")
def sector_keyword_any(spark, sf):
    sectors = F.split("p_name", " ")
    hit = F.exists(sectors, lambda s: F.ilike(s, F.lit("%ring%"))) | F.ilike("p_type", F.lit("%promo%"))
    return table(spark, sf, "part").filter(hit).select("p_partkey", sectors.alias("sectors"))


@query(
    "classify_tiers",
    f"""with {FIRMS_SQL} select crd, case when by_name then 'strong' when text then 'strong_text'
      when regexp_matches(name, '(?i)\\bfamily\\s+(capital|wealth|partners|investments?|holdings|advisor|advisors|advisers|group|trust|management|enterprises?)\\b') or regexp_matches(name, '\\bMFO\\b') then 'medium'
      when coalesce(share, 0) >= 0.75 and clients > 0 and clients <= 15 then 'client_mix' end as tier from g1""",
)
def classify_tiers(spark, sf):
    clients = rules.zero(F.col("hnw")) + rules.zero(F.col("other"))
    return firms(spark, sf).select("crd", rules.discovery_tier(F.col("name"), F.col("free_text"), rules.ratio(F.col("hnw_raum"), F.col("raum")), clients).alias("tier"))


@query("tier_summary", f"with {FIRMS_SQL} select decision, count(*) as n from gated group by 1")
def tier_summary(spark, sf):
    return gated(spark, sf).groupBy("decision").agg(F.count("*").alias("n"))


TITLES = ["Founder", "Managing Partner", "CEO", "Vice President", "President", "Principal", "Partner", "Analyst"]
RANK_SQL = "case o_orderkey % 8 when 0 then 100 when 1 then 95 when 2 then 90 when 3 then 10 when 4 then 85 when 5 then 70 when 6 then 45 else 10 end"


@query(
    "top2_contacts_pivot",
    f"""with r as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by {RANK_SQL} desc, o_orderkey) as n from orders)
    select o_custkey as crd, max(case when n = 1 then o_orderkey end) as primary_id, max(case when n = 2 then o_orderkey end) as secondary_id from r where n <= 2 group by 1""",
)
def top2_contacts_pivot(spark, sf):
    title = F.element_at(F.array(*map(F.lit, TITLES)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    two = keyed.first_rows(table(spark, sf, "orders").withColumn("rank", rules.title_rank(title)), ["o_custkey"], 2, F.desc("rank"), F.asc("o_orderkey"))
    pick = lambda n: F.max(F.when(F.col("#n") == n, F.col("o_orderkey")))
    return two.groupBy(F.col("o_custkey").alias("crd")).agg(pick(1).alias("primary_id"), pick(2).alias("secondary_id"))


@query("gate_score", f"with {FIRMS_SQL} select crd, score, decision, category, n_evidence, n_against from gated")
def gate_score(spark, sf):
    return gated(spark, sf).select("crd", "score", "decision", "category", F.size("evidence").alias("n_evidence"), F.size("contradictions").alias("n_against"))


@query("release_band", f"with {FIRMS_SQL} select crd, route, route in ('client_mix', 'concordant') as released from gated")
def release_band(spark, sf):
    return gated(spark, sf).select("crd", "route", "released")


@query("release_precedence", f"with {FIRMS_SQL} select crd, release_state, release_basis, person_status, final_category from records")
def release_precedence(spark, sf):
    return records(spark, sf).select("crd", "release_state", "release_basis", "person_status", "final_category")


GRADE_SQL = "case crd % 6 when 0 then 'PUB' when 1 then 'A' when 2 then 'B' when 3 then 'C' end"
PHONE_SQL, PAGE_SQL = "case when crd % 4 < 2 then '555-010-' || crd end", "case when crd % 5 < 2 then 'https://pages.example.com/company/' || crd end"


def reachable(spark, sf):
    k, text = F.col("crd"), F.col("crd").cast("string")
    grade = cases(k % 6, [(0, "PUB"), (1, "A"), (2, "B"), (3, "C")])
    return records(spark, sf).withColumns({"grade": grade, "phone": F.when(k % 4 < 2, F.concat(F.lit("555-010-"), text)), "page": F.when(k % 5 < 2, F.concat(F.lit("https://pages.example.com/company/"), text))})


@query(
    "completion_reach_confidence",
    f"""with {FIRMS_SQL}, x as (select *, {GRADE_SQL} as grade, {PHONE_SQL} as phone, {PAGE_SQL} as page, release_state = 'qualifying' as q, coalesce(person_status, '') = 'proven' as p from records),
    y as (select *, case when q and p then case when grade = 'PUB' then 100 when grade = 'A' then 85 when grade = 'B' then 60 when phone is not null and page is not null then 45 when phone is not null or page is not null then 25 else 0 end end as reach from x)
    select crd, round(100.0 * ((name is not null)::int + (domain is not null)::int + (site is not null)::int + (profile is not null)::int + (state is not null)::int + (phone is not null)::int + (page is not null)::int + (free_text is not null)::int + (grade is not null)::int + (segment is not null)::int + (final_category is not null)::int) / 11)::int as completion,
      reach, case when reach >= 85 then 'High' when reach >= 45 then 'Medium' when reach is not null then 'Low' end as tier,
      case when q then least(100, 40 + case when has_contact then 40 else 25 end + case when grade = 'PUB' then 20 when grade in ('A', 'B') then 10 else 5 end) end as confidence from y""",
)
def completion_reach_confidence(spark, sf):
    r = reachable(spark, sf)
    q, p = F.col("release_state") == "qualifying", F.coalesce(F.col("person_status") == "proven", F.lit(False))
    tier, reach = rules.reachability(q, p, F.col("grade"), F.col("phone"), F.col("page"))
    filled = rules.completion(*(F.col(c) for c in ("name", "domain", "site", "profile", "state", "phone", "page", "free_text", "grade", "segment", "final_category")))
    basis = F.when(F.col("has_contact"), "stated").otherwise("title")
    return r.select("crd", filled.alias("completion"), reach.alias("reach"), tier.alias("tier"), rules.confidence(q, basis, F.col("grade")).alias("confidence"))


@query(
    "outreach_channel",
    f"""with {FIRMS_SQL}, x as (select crd, domain, {GRADE_SQL} as g, case when crd % 9 <> 0 then 'p' || crd || '@example.com' end as e, case when crd % 7 = 0 then 'A' else 'C' end as sg, 's' || crd || '@example.com' as se, {PHONE_SQL} as phone, {PAGE_SQL} as page from records)
    select crd, case when (g in ('PUB', 'A', 'B') and e is not null) or sg = 'A' then 'email' when phone is not null then 'phone' when page is not null then 'linkedin' else 'research' end as channel,
      case when g in ('PUB', 'A', 'B') and e is not null then e when sg = 'A' then se when phone is not null then phone when page is not null then page else domain end as target from x""",
)
def outreach_channel(spark, sf):
    text = F.col("crd").cast("string")
    r = reachable(spark, sf).withColumns({"e": F.when(F.col("crd") % 9 != 0, F.concat(F.lit("p"), text, F.lit("@example.com"))), "sg": F.when(F.col("crd") % 7 == 0, "A").otherwise("C"), "se": F.concat(F.lit("s"), text, F.lit("@example.com"))})
    channel, target = rules.channel(F.col("grade"), F.col("e"), F.col("sg"), F.col("se"), F.col("phone"), F.col("page"), F.col("domain"))
    return r.select("crd", channel.alias("channel"), target.alias("target"))


# Names in the forms that the parser has to handle, by supplier number.
NAME_FORMS = ["José O'Brien", "Eliza (Happy) Rowe", "Anne-Marie van Dyke, CFA", "Dr. John Q. Public Jr", "Cher", "Putnam, III", "III"]
PARTS_SQL = "case s_suppkey % 7 when 0 then ['jose', 'obrien'] when 1 then ['eliza', 'rowe'] when 2 then ['annemarie', 'dyke'] when 3 then ['john', 'public'] when 4 then ['cher'] when 5 then ['putnam'] end"
DOMAIN_SQL = "case when s_suppkey % 5 = 0 then 'catchall' else 'firm' end || (s_suppkey % 10) || '.example.com'"
CANDIDATES_SQL = f"""p as (select s_suppkey, {PARTS_SQL} as ps, {DOMAIN_SQL} as d from supplier),
c as (select s_suppkey, unnest(generate_series(0, len(xs) - 1)) as pos, xs, d from (select s_suppkey, d, case len(ps) when 2 then [ps[1] || '.' || ps[2], ps[1][1] || ps[2], ps[1] || ps[2], ps[1], ps[1] || '_' || ps[2], ps[1][1] || '.' || ps[2], ps[2] || ps[1][1]] when 1 then [ps[1]] end as xs from p) where xs is not null),
e as (select s_suppkey, pos::int as pos, xs[pos + 1] || '@' || d as email, xs[pos + 1] as local, d from c)"""


def people(spark, sf):
    name = F.element_at(F.array(*map(F.lit, NAME_FORMS)), (F.col("s_suppkey") % 7 + 1).cast("int"))
    domain = F.concat(F.when(F.col("s_suppkey") % 5 == 0, "catchall").otherwise("firm"), (F.col("s_suppkey") % 10).cast("string"), F.lit(".example.com"))
    return table(spark, sf, "supplier").select("s_suppkey", name.alias("name"), domain.alias("domain"))


@query("email_candidates", f"with {CANDIDATES_SQL} select s_suppkey, pos, email from e")
def email_candidates(spark, sf):
    return contacts.candidates(people(spark, sf)).select("s_suppkey", "pos", "email")


@query(
    "email_grade_api",
    f"""with {CANDIDATES_SQL}, v as (select *, case when d like '%catchall%' then 'catch_all' when local like '%.%' and local not like '%.' then 'ok' else 'invalid' end as result from e where pos < 4),
    s as (select s_suppkey, min(case when result <> 'invalid' then pos end) as stop, bool_and(result = 'invalid') as bad from v group by 1)
    select s.s_suppkey, coalesce(case when x.result = 'ok' then x.email end, y.email) as email, case when x.result = 'ok' then 'A' when x.result = 'catch_all' then 'B' when bad then 'D' else 'C' end as grade,
      case when x.result = 'ok' then 'VERIFIED_API' when x.result = 'catch_all' then 'INFERRED_CATCHALL' when bad then 'INVALID_API' else 'UNKNOWN_API' end as code
    from s left join v x on x.s_suppkey = s.s_suppkey and x.pos = s.stop join v y on y.s_suppkey = s.s_suppkey and y.pos = 0""",
)
def email_grade_api(spark, sf):
    options = contacts.candidates(people(spark, sf))
    return contacts.graded(options.withColumn("result", contacts.mock_verdict(F.col("email"))), ["s_suppkey"])


@query(
    "domain_block_ladder",
    """with p as (select s_suppkey, s_nationkey, s_suppkey % 4 = 0 as unknown, (s_suppkey % 3)::int as k from supplier)
    select s_suppkey, coalesce(max(unknown::int) over (partition by s_nationkey order by s_suppkey rows between unbounded preceding and 1 preceding) > 0, false) as blocked,
      case when s_suppkey % 10 = 0 then 'F' when k = 0 then 'B' when k = 1 or s_suppkey % 7 = 0 then 'C' when s_suppkey % 2 = 0 then case when s_suppkey % 4 = 0 then 'A+' else 'A' end else 'C' end as grade from p""",
)
def domain_block_ladder(spark, sf):
    k = F.col("s_suppkey")
    catch_all = F.when(k % 3 == 0, True).when(k % 3 == 2, False)
    grade = contacts.ladder(k % 10 != 0, catch_all, F.when(k % 7 == 0, "microsoft365").otherwise("other"), F.when(k % 2 == 0, 250).otherwise(550), k % 4 == 0)
    marked = contacts.domain_blocked(table(spark, sf, "supplier"), k % 4 == 0, ["s_nationkey"], ["s_suppkey"])
    return marked.select("s_suppkey", "blocked", grade.alias("grade"))


@query(
    "contact_overlay",
    """with r as (select lower('p' || c_custkey || '@example.com') as e from customer where c_custkey % 6 = 0), c as (select c_custkey as crd, case when c_custkey % 2 = 0 then 'P' || c_custkey || '@example.com' end as pub, case when c_custkey % 3 < 2 then 'i' || c_custkey || '@example.com' end as inf,
      case c_custkey % 5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' end as g from customer)
    select crd, case when pub is not null and crd % 6 <> 0 then pub when g in ('A', 'B') and inf is not null then inf end as email, case when pub is not null and crd % 6 <> 0 then 'PUB' when g in ('A', 'B') and inf is not null then g end as grade,
      case when pub is not null and crd % 6 <> 0 then 'published' when g in ('A', 'B') and inf is not null then 'inferred' when g = 'C' then 'withheld_unconfirmed' when g in ('D', 'F') and inf is not null then 'audited' else 'none' end as outcome from c""",
)
def contact_overlay(spark, sf):
    k, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
    base = table(spark, sf, "customer").select(k.alias("crd"), F.when(k % 2 == 0, F.concat(F.lit("P"), text, F.lit("@example.com"))).alias("pub"), F.when(k % 3 < 2, F.concat(F.lit("i"), text, F.lit("@example.com"))).alias("inf"), cases(k % 5, [(0, "A"), (1, "B"), (2, "C"), (3, "D")]).alias("g"))
    audit = table(spark, sf, "customer").filter("c_custkey % 6 = 0").groupBy(k.alias("crd")).agg(F.collect_set(F.concat(F.lit("p"), text, F.lit("@example.com"))).alias("rejected"))
    email, grade, outcome = release.contact_email(F.col("pub"), F.col("inf"), F.col("g"), F.coalesce("rejected", F.array().cast("array<string>")))
    return base.join(audit, "crd", "left").select("crd", email.alias("email"), grade.alias("grade"), outcome.alias("outcome"))


@query(
    "surface_partition_reconcile",
    f"""with {FIRMS_SQL}, s as (select *, case when release_state = 'quarantined' then 'quarantined' when release_state = 'qualifying' and final_category = 'embedded_fo_practice' then 'practices' when release_state = 'qualifying' then 'product'
      when final_category is null then 'awaiting_adjudication' when final_category in ('single_family_office', 'multi_family_office', 'embedded_fo_practice') then 'pending' else 'reclassified' end as surface from records)
    select 'every_record_has_a_surface' as "check", count(*) filter (where surface is null) as failures, count(*) filter (where surface is null) = 0 as ok from s
    union all select 'qualifying_has_basis', count(*) filter (where release_state = 'qualifying' and release_basis is null), count(*) filter (where release_state = 'qualifying' and release_basis is null) = 0 from s
    union all select 'no_duplicate_qualifies', count(*) filter (where release_state = 'qualifying' and duplicate_of is not null), count(*) filter (where release_state = 'qualifying' and duplicate_of is not null) = 0 from s
    union all select 'proven_without_contact', count(*) filter (where person_status = 'proven' and not has_contact), count(*) filter (where person_status = 'proven' and not has_contact) = 0 from s
    union all select 'qualifying_by_gate_outside_band', count(*) filter (where release_basis = 'gate_released' and route not in ('client_mix', 'concordant')), count(*) filter (where release_basis = 'gate_released' and route not in ('client_mix', 'concordant')) = 0 from s
    union all select 'surface:' || surface, count(*), false from s group by surface""",
)
def surface_partition_reconcile(spark, sf):
    s = records(spark, sf).withColumn("surface", release.surface(F.col("release_state"), F.col("final_category")))
    qualifies = F.col("release_state") == "qualifying"
    return release.checks(s, {
        "every_record_has_a_surface": F.col("surface").isNull(),
        "qualifying_has_basis": qualifies & F.col("release_basis").isNull(),
        "no_duplicate_qualifies": qualifies & F.col("duplicate_of").isNotNull(),
        "proven_without_contact": (F.col("person_status") == "proven") & ~F.col("has_contact"),
        "qualifying_by_gate_outside_band": (F.col("release_basis") == "gate_released") & ~F.col("released"),
    }, "surface")


@query(
    "over_inclusion_ratio",
    "select o_custkey as crd, count(*) as people, count(*) filter (where o_orderstatus = 'O') as principals from orders group by 1 having count(*) >= 4 and count(*) filter (where o_orderstatus = 'O') / count(*) >= 0.6",
)
def over_inclusion_ratio(spark, sf):
    sums = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("crd")).agg(F.count("*").alias("people"), F.count_if(F.col("o_orderstatus") == "O").alias("principals"))
    return sums.filter((F.col("people") >= 4) & (F.try_divide("principals", "people") >= 0.6))
