"""Queries of the work lists around fetching. Customers stand in for candidates, events for tries and probes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions.text import registered_domain
from quillon.operators import frontier, review
from quillon.operators.storage import shared_path
from quillon.plans.captures import DOMAIN
from quillon.plans.records import FIRMS_SQL, cases, gated, table
from quillon.registry import query
from quillon.sources import feeds

SITES = ["https://www.LinkedIn.com/company/x", "https://firm.example.com", "https://x.com", "", "https://fox.com/team"]
SITE_SQL = "case c_custkey % 6 when 5 then null else (['https://www.LinkedIn.com/company/x', 'https://firm.example.com', 'https://x.com', '', 'https://fox.com/team'])[c_custkey % 6 + 1] end"


def _site(k):
    return cases(k % 6, list(enumerate(SITES)))


@query("own_sites", f"select c_custkey as key, not coalesce(c_custkey % 6 in (0, 2), false) as own, coalesce(c_custkey % 6 in (0, 2, 4), false) as social from customer")
def own_sites(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.alias("key"), frontier.own_site(_site(k)).alias("own"), frontier.social(_site(k)).alias("social"))


@query(
    "crawl_frontier",
    f"""with {FIRMS_SQL} select crd as key, name from gated where domain is not null order by case when by_name then 0 when text then 1 when share >= 0.5 then 2 else 3 end, raum desc nulls last, crd limit 40""",
)
def crawl_frontier(spark, sf):
    named = F.exists("evidence", lambda e: e["rule"] == "name_fo_strong")
    tier = F.when(F.exists("evidence", lambda e: e["rule"] == "adv_freetext_fo"), "strong").when(F.col("share") >= 0.5, "medium").otherwise("client_mix")
    firms = gated(spark, sf).select(F.col("crd").alias("key"), "name", F.col("domain").alias("website"), tier.alias("tier"), F.when(named, "name_contains_family_office").otherwise("").alias("reasons"), "raum")
    return frontier.crawl_frontier(firms, 40).select("key", "name")


@query("host_turns", f"select page_id as id, {DOMAIN} as host, (row_number() over (partition by {DOMAIN} order by page_id) - 1)::double as starts from pages")
def host_turns(spark, sf):
    return frontier.host_turns(table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url")).select("id", "host", "starts")


LINES_SQL = "u as (select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_suppkey) as l_suppkey from lineitem group by 1, 2)"


def _lines(spark, sf):
    """One row for each number of an order: the tries of a fetch, or of a probe."""
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))


@query(
    "fetch_retries",
    f"""with {LINES_SQL}, t as (select l_orderkey as url, l_linenumber - 1 as attempt, case l_partkey % 5 when 0 then 200 when 1 then 429 when 2 then 503 when 3 then 404 end as status, l_suppkey % 2 = 0 as insecure, case when l_partkey % 3 = 0 then 40 when l_partkey % 3 = 1 then 7 end as ra from u),
    e as (select url, coalesce(min(attempt) filter (where status in (200, 404)), max(attempt)) as a from t where attempt < 3 group by 1)
    select t.url, status, insecure, (t.attempt + 1)::int as attempts, coalesce((select sum(least(30.0, coalesce(w.ra::double, 2.0 ** w.attempt))) from t w where w.url = t.url and w.attempt < t.attempt), 0.0)::double as waited,
      case when status is null then 'unreachable' when status >= 400 then 'http_' || status end as error from t join e on t.url = e.url and t.attempt = e.a""",
)
def fetch_retries(spark, sf):
    status = cases(F.col("l_partkey") % 5, [(0, 200), (1, 429), (2, 503), (3, 404)])
    tries = _lines(spark, sf).select(F.col("l_orderkey").alias("url"), (F.col("l_linenumber") - 1).cast("int").alias("attempt"), status.alias("status"), (F.col("l_suppkey") % 2 == 0).alias("insecure"), cases(F.col("l_partkey") % 3, [(0, 40), (1, 7)]).alias("retry_after"))
    return frontier.fetched(tries)


CAPTURES_SQL = f"c as (select page_id as id, {DOMAIN} as key, regexp_replace(url, '[?#].*$', '') as url, case page_id % 3 when 0 then 'home' when 1 then 'about' else 'team' end as kind, case when page_id % 7 > 0 then (['We are a multi-family office.', 'Our family office services team and family office', 'A single family office', 'Nothing'])[page_id % 4 + 1] end as text from pages), n as (select distinct on (key, url) * from c order by key, url, id desc)"


def captures(spark, sf):
    k = F.col("page_id")
    text = F.when(k % 7 > 0, cases(k % 4, list(enumerate(["We are a multi-family office.", "Our family office services team and family office", "A single family office", "Nothing"]))))
    return table(spark, sf, "pages").select(k.alias("id"), registered_domain(F.col("url")).alias("key"), F.regexp_replace("url", "[?#].*$", "").alias("url"), cases(k % 3, [(0, "home"), (1, "about")], "team").alias("kind"), text.alias("text"))


@query("page_bundles", f"with {CAPTURES_SQL} select key, count(*) as pages, list(url order by url) as urls, left(string_agg(coalesce(text, ''), ' ' order by url), 100) as text from n where key in (select key from c where id % 5 = 0) group by 1")
def page_bundles(spark, sf):
    rows = captures(spark, sf)
    return frontier.page_bundles(rows, rows.filter("id % 5 = 0"), 100)


@query("capture_lineage", f"with {CAPTURES_SQL} select key, url, id from n where url in (select url from c where id % 4 = 0)")
def capture_lineage(spark, sf):
    rows = captures(spark, sf)
    return frontier.lineage(rows, rows.filter("id % 4 = 0"))


@query(
    "site_evidence",
    f"""with {CAPTURES_SQL}, e as (select key, url, case kind when 'home' then 0 when 'about' then 1 else 2 end as place, coalesce(len(regexp_extract_all(text, '(?i)family[\\s-]+office')), 0) as n, list_filter([case when text ilike '%single family office%' then 'single_family_office' end, case when text ilike '%multi-family office%' then 'multi_family_office' end,
      case when text ilike '%family office services%' then 'ria_with_fo_practice' end], lambda x: x is not null) as st from n)
    select key, sum(n)::bigint as phrases, min(case when len(st) > 0 then [place::varchar, url, st[1]] end)[3] as category, sum(coalesce(len(st), 0))::bigint as signals from e group by 1""",
)
def site_evidence(spark, sf):
    return frontier.site_evidence(captures(spark, sf), dict(review.SELF_DESCRIPTIONS), "(?i)family[\\s-]+office")


ATTEMPTS_SQL = "a as (select user_id as key, count(*) as attempts, max(epoch_us(ts)) as last_at from events where event_type <> 'purchase' group by 1)"


def attempts(spark, sf):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return frontier.attempts(table(spark, sf, "events").select(F.col("user_id").alias("key"), at.alias("at"), (F.col("event_type") == "purchase").alias("succeeded")))


@query("attempt_counts", f"with {ATTEMPTS_SQL} select * from a")
def attempt_counts(spark, sf):
    return attempts(spark, sf)


@query("resolve_queue", f"with {ATTEMPTS_SQL}, c as (select c_custkey as key, {SITE_SQL} as website, case when c_custkey % 8 = 0 then 'known.example.com' end as domain from customer) select c.key, coalesce(attempts, 0) as attempts from c left join a using (key) where domain is null and (coalesce(website, '') = '' or key % 6 in (0, 2, 4)) order by 2, 1 limit 40")
def resolve_queue(spark, sf):
    k = F.col("c_custkey")
    candidates = table(spark, sf, "customer").select(k.alias("key"), _site(k).alias("website"), F.when(k % 8 == 0, "known.example.com").alias("domain"))
    return frontier.resolve_queue(candidates, attempts(spark, sf), 40).select("key", "attempts")


@query("queue_reopen", "select c_custkey as key, 'gated' as from_stage, 'discovered' as stage, 'pending' as status, 'https://firm' || c_custkey || '.example.com' as website, 'name and city' as basis from customer where c_custkey % 3 <> 0 and c_custkey % 4 = 0")
def queue_reopen(spark, sf):
    k = F.col("c_custkey")
    queue = table(spark, sf, "customer").select(k.alias("key"), F.lit("gated").alias("stage"), F.when(k % 3 == 0, "pending").otherwise("done").alias("status"))
    proofs = table(spark, sf, "customer").filter("c_custkey % 4 = 0").select(k.alias("key"), F.concat(F.lit("firm"), k.cast("string"), F.lit(".example.com")).alias("domain"), F.lit("name and city").alias("basis"))
    return frontier.reopened(queue, proofs)


HOSTS = ["Firm.Mail.Protection.Outlook.com", "ASPMX.l.google.com", "mx1.pphosted.com", "smtp.zohomail.com", "mail.example.com"]


@query(
    "mail_domains",
    "select 'd' || s_suppkey as domain, s_suppkey % 7 <> 0 and s_suppkey % 6 <> 5 as mx_ok, case s_suppkey % 6 when 0 then 'microsoft365' when 1 then 'google' when 2 then 'proofpoint' when 3 then 'zoho' else 'other' end as provider, case s_suppkey % 4 when 0 then true when 1 then false end as catch_all from supplier",
)
def mail_domains(spark, sf):
    k = F.col("s_suppkey")
    hosts = F.when(k % 6 < 5, F.array(F.lit("other.example.net"), cases(k % 6, list(enumerate(HOSTS))))).otherwise(F.array().cast("array<string>"))
    domains = table(spark, sf, "supplier").select(F.concat(F.lit("d"), k.cast("string")).alias("domain"), hosts.alias("hosts"), (k % 7 != 0).alias("resolves"), cases(k % 4, [(0, 250), (1, 550), (2, 421)]).alias("code"))
    return frontier.assessed(domains)


@query(
    "address_probes",
    f"""with {LINES_SQL}, a as (select l_orderkey as key, l_linenumber as pos, case l_partkey % 5 when 0 then 250 when 1 then 550 when 2 then 421 when 3 then 551 end as code from u),
    d as (select *, coalesce(max((code between 200 and 299 or code is null)::int) over (partition by key order by pos rows between unbounded preceding and 1 preceding), 0) as done from a)
    select key, pos, code, case when code between 200 and 299 then true when code between 500 and 599 then false end as verdict from d where done = 0""",
)
def address_probes(spark, sf):
    code = cases(F.col("l_partkey") % 5, [(0, 250), (1, 550), (2, 421), (3, 551)])
    return frontier.probed(_lines(spark, sf).select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("pos"), code.alias("code")))


@query("embedding_seam", "select doc_id as id, [length(t)::double, length(t) - length(replace(t, 'e', '')), length(t) - length(replace(t, ' ', ''))]::double[] as vector from (select doc_id, coalesce(text, '') as t from documents)")
def embedding_seam(spark, sf):
    """A deterministic encoder in the place of a model."""
    encode = lambda texts: [[float(len(t)), float(t.count("e")), float(t.count(" "))] for t in texts]
    return frontier.embedded(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), encode)


@query("feed_manifest", "select 'IA_FIRM_SEC_2.xml.gz' as name")
def feed_manifest(spark, sf):
    path = shared_path(spark, "manifest")
    body = '{"files": [{"name": "IA_FIRM_STATE_1.xml.gz", "size": 3},\n {"name": "IA_FIRM_SEC_2.xml.gz"}, {"name": "IA_FIRM_SEC_1.xml.gz"}]}'
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(path)
    return feeds.current_feed(spark, path, "IA_FIRM_SEC_")


@query(
    "submission_profiles",
    "select s_suppkey as key, case when s_suppkey % 3 = 0 then s_suppkey || ' Main' end as street, case when s_suppkey % 3 = 0 then 'Troy' end as city, case when s_suppkey % 3 = 0 then 'NY' end as state, null::varchar as zip, null::varchar as phone, case when s_suppkey % 3 < 2 then '12-' || s_suppkey end as ein, case s_suppkey % 3 when 1 then 'no business address' when 2 then 'empty' end as error from supplier",
)
def submission_profiles(spark, sf):
    k = F.col("s_suppkey").cast("string")
    ein = F.concat(F.lit("EIN:   12-"), k, F.lit("\n"))
    whole = F.concat(ein, F.lit("BUSINESS ADDRESS:\n STREET 1: "), k, F.lit(" Main\n CITY: Troy\n STATE: NY\nMAIL ADDRESS:\n CITY: Elsewhere"))
    text = F.when(F.col("s_suppkey") % 3 == 0, whole).when(F.col("s_suppkey") % 3 == 1, ein)
    return feeds.profiles(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), text.alias("text")))


@query("registry_snapshots", "select s_suppkey as key, s_suppkey % 2 = 0 as found, case when s_suppkey % 2 = 0 then 'Firm ' || s_suppkey end as firm_name, case when s_suppkey % 2 = 0 then '2026-03-' || lpad((1 + s_suppkey % 28)::varchar, 2, '0') end as filed from supplier")
def registry_snapshots(spark, sf):
    k = F.col("s_suppkey")
    inner = F.concat(F.lit('{\\"basicInformation\\": {\\"firmName\\": \\"Firm '), k.cast("string"), F.lit('\\", \\"iaScope\\": \\"ACTIVE\\", \\"advFilingDate\\": \\"3/'), (1 + k % 28).cast("string"), F.lit('/2026\\"}}'))
    answer = F.when(k % 2 == 0, F.concat(F.lit('{"hits": {"hits": [{"_source": {"iacontent": "'), inner, F.lit('"}}]}}'))).otherwise('{"hits": {"hits": []}}')
    return table(spark, sf, "supplier").select(k.alias("key"), feeds.registry_snapshot(answer).alias("s")).select("key", "s.found", "s.firm_name", "s.filed")
