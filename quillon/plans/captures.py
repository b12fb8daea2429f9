"""Queries over captures: pages, feeds, duplicates, domains, changes of facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import text
from quillon.operators import entities, keyed
from quillon.operators.storage import shared_path
from quillon.plans.records import cases, table
from quillon.registry import query
from quillon.sources import feeds, pages


@query(
    "capture_dedupe",
    """with c as (select source, doc_id, sha256(coalesce(length(source) || ':' || source, '-') || '|' || coalesce(length(text) || ':' || text, '-')) as content_hash from documents), n as (select *, row_number() over (partition by source, content_hash order by doc_id) as k from c)
    select source, doc_id, content_hash from n where k = 1 and not exists (select 1 from c h where h.doc_id % 10 = 3 and h.source = n.source and h.content_hash = n.content_hash)""",
)
def capture_dedupe(spark, sf):
    captures = table(spark, sf, "documents").select("source", "doc_id", keyed.fingerprint(F.col("source"), F.col("text")).alias("content_hash"))
    return keyed.new_captures(captures, captures.filter("doc_id % 10 = 3"), ["source", "content_hash"], F.asc("doc_id"))


@query(
    "page_stitch_budget",
    r"""with p as (select conv_id as key, turn, role, text, coalesce(sum(length(text)) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as before from conversations)
    select key, coalesce(string_agg(case when before < 1000 then '[' || role || '] ' || left(text, (1000 - before)::bigint) end, chr(10) order by turn), '') as stitched, count(*) as pages from p group by key""",
)
def page_stitch_budget(spark, sf):
    return pages.stitched(table(spark, sf, "conversations").select(F.col("conv_id").alias("key"), F.col("turn").alias("pos"), F.col("role").alias("kind"), "text"), 1000)


DOMAIN = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"


@query("url_domain_normalise", f"select page_id, {DOMAIN} as domain, starts_with(url, 'https://') as secure from pages")
def url_domain_normalise(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.registered_domain(F.col("url")).alias("domain"), F.col("url").startswith("https://").alias("secure"))


@query(
    "html_text_links",
    r"""select page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) as title, len(regexp_extract_all(html, '(?is)<a [^>]*href="[^"]*"[^>]*>.*?</a>')) as n_links,
      substr(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')), 1, 20000) as text from pages""",
)
def html_text_links(spark, sf):
    rows = table(spark, sf, "pages")
    count = pages.links(rows).groupBy("page_id").agg(F.count("*").alias("n_links"))
    return rows.select("page_id", pages.title(F.col("html")).alias("title"), pages.text(F.col("html")).alias("text")).join(count, "page_id", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))


#: A navigation bar in which every rule of link discovery has a case.
NAV = '<a href="/about-us#x">About</a><a href="/our-team/">Team</a><a href="/about-us">again</a><a href="https://other.example.org/team">x</a><a href="/get-in-touch">Write</a><a href="/what-we-do">Us</a><a href="/staff">All</a><a href="mailto:a@example.org">team</a>'


def _kind_case(hay: str) -> str:
    return "case " + " ".join(f"when regexp_matches({hay}, '{w}') then '{k}'" for k, w in pages.LINK_KINDS.items()) + " end"


@query(
    "link_discovery",
    rf"""with a as (select page_id, url, unnest(regexp_extract_all(html, '(?is)<a [^>]*href="[^"]*"[^>]*>.*?</a>')) as a, generate_subscripts(regexp_extract_all(html, '(?is)<a [^>]*href="[^"]*"[^>]*>.*?</a>'), 1) as pos from (select page_id, url, html || '{NAV}' as html from pages)),
    h as (select page_id, url, pos, regexp_extract(a, '(?i)href="([^"]*)"', 1) as href, trim(regexp_replace(a, '(?s)<[^>]*>', '', 'g')) as anchor from a),
    t as (select *, regexp_replace(regexp_replace(case when regexp_matches(href, '^https?://') then href when starts_with(href, '/') then regexp_extract(url, '^(https?://[^/?#]*)', 1) || href end, '#.*$', ''), '/+$', '') as target from h),
    k as (select *, {_kind_case("lower(href || ' ' || anchor)")} as kind from t where target is not null and {DOMAIN.replace("url", "target")} = {DOMAIN} and target <> regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '')),
    o as (select *, row_number() over (partition by page_id, target order by pos) as once from k where kind is not null),
    n as (select page_id, target, kind, row_number() over (partition by page_id order by case kind when 'team' then 1 when 'about' then 2 when 'strategy' then 3 else 4 end, pos) as nth from o where once = 1)
    select page_id, nth, target, kind from n where nth <= 4""",
)
def link_discovery(spark, sf):
    return pages.discovered(table(spark, sf, "pages").withColumn("html", F.concat("html", F.lit(NAV))))


REFERENCES = [
    "team.html", "../about", "./staff/./x/../people", "//www.other.example.org/team", "?tab=team", "", "/a/b/../c/", "../../../../up", "x/..", ".", "..", "http://a.example.org/p/../q?r=/../s", "mailto:a@example.org", "/one?two=/../three", "g;x=1/../y", "/team/#top",
]


@query(
    "link_resolution",
    r"""with r as (select page_id, case page_id % 3 when 0 then url || '/deep/er/page.html?q=1' when 1 then url || '/?v' else url end as base, pos, ref0 from pages, (select unnest(generate_series(1, """
    + f"{len(REFERENCES)})) as pos, unnest([{', '.join(repr(r) for r in REFERENCES)}]) as ref0)"
    + r"""),
    a as (select *, regexp_replace(ref0, '#.*$', '') as ref, regexp_extract(base, '^(https?://[^/?#]*)') as origin, regexp_extract(base, '^https?://[^/?#]*([^?#]*)', 1) as own, regexp_extract(base, '^[^?#]*(\?[^#]*)', 1) as q from r),
    b as (select *, case when regexp_matches(ref, '^https?://') then ref when starts_with(ref, '//') then regexp_extract(base, '^https?:') || ref when regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*:') then null
      when ref = '' then origin || own || q when starts_with(ref, '?') then origin || own || ref when starts_with(ref, '/') then origin || ref else origin || case when own = '' then '/' else regexp_extract(own, '^(.*/)', 1) end || ref end as whole from a),
    c as (select *, regexp_extract(whole, '^(https?://[^/?#]*)') as head, regexp_extract(whole, '^https?://[^/?#]*([^?#]*)', 1) as path, regexp_extract(whole, '(\?[^#]*)', 1) as tail from b),
    d as (select *, list_reduce(list_prepend([''], list_transform(string_split(path, '/')[2:], lambda s: [s])), lambda h, x: case when x[1] = '..' then h[:greatest(len(h) - 1, 1)] when x[1] = '.' then h else list_concat(h, x) end) as kept from c)
    select page_id, pos::int as pos, case when whole is null then ref when path = '' or ref = '' or starts_with(ref, '?') then whole else head || array_to_string(kept, '/') || case when regexp_matches(path, '/\.{1,2}$') then '/' else '' end || tail end as target from d""".replace("\\\\", "\\"),
)
def link_resolution(spark, sf):
    """References of every kind on each page, resolved against three forms of its address."""
    k, url = F.col("page_id"), F.col("url")
    base = F.when(k % 3 == 0, F.concat(url, F.lit("/deep/er/page.html?q=1"))).when(k % 3 == 1, F.concat(url, F.lit("/?v"))).otherwise(url)
    each = table(spark, sf, "pages").select("page_id", base.alias("base"), F.posexplode(F.array(*map(F.lit, REFERENCES))).alias("at", "ref"))
    return each.select("page_id", (F.col("at") + 1).alias("pos"), pages.resolved(F.col("base"), F.col("ref")).alias("target"))


@query("html_parser")
def html_parser(spark, sf):
    return pages.parsed(table(spark, sf, "pages"))


@query(
    "url_quality",
    f"""with c as (select page_id as id, {DOMAIN} as key, regexp_replace(url, '[?#].*$', '') as url, case when page_id % 9 = 0 then 404 else 200 end as status, starts_with(url, 'http://') as insecure, page_id % 2 = 0 as home from pages),
    n as (select distinct on (key, url) * from c order by key, url, id desc), s as (select key, count(*) as pages, bool_or(home and status = 200) as home, bool_or(insecure) as insecure from n group by 1)
    select key, pages, case when not home then 'unreachable' when insecure then 'insecure' when pages >= 3 then 'full' else 'partial' end as level from s""",
)
def url_quality(spark, sf):
    rows = table(spark, sf, "pages").select(F.col("page_id").alias("id"), text.registered_domain(F.col("url")).alias("key"), F.regexp_replace("url", "[?#].*$", "").alias("url"), F.when(F.col("page_id") % 9 == 0, 404).otherwise(200).alias("status"), F.col("url").startswith("http://").alias("insecure"), F.when(F.col("page_id") % 2 == 0, "home").otherwise("team").alias("kind"))
    return pages.quality(rows)


@query("duplicate_domain_groups", f"with p as (select page_id as key, {DOMAIN} as domain from pages), g as (select domain, list(key order by key) as keys from p group by 1 having count(*) > 1) select key, domain, list_filter(keys, lambda k: k <> key) as others from p join g using (domain)")
def duplicate_domain_groups(spark, sf):
    return entities.same_domain(table(spark, sf, "pages").select(F.col("page_id").alias("key"), text.registered_domain(F.col("url")).alias("domain")))


@query(
    "dedupe_vs_held",
    """with c as (select 'crd:' || c_custkey as key, 'Customer ' || (c_custkey % 400) as name from customer), h as (select 'crd:' || s_suppkey as key, 'CUSTOMER-' || (s_suppkey + 50) as name from supplier union select 'crd:' || (c_custkey + 1000), c_name from customer)
    select key, name from c where key not in (select key from h) and regexp_replace(lower(name), '[^a-z0-9]', '', 'g') not in (select regexp_replace(lower(name), '[^a-z0-9]', '', 'g') from h)""",
)
def dedupe_vs_held(spark, sf):
    key = lambda c: F.concat(F.lit("crd:"), c.cast("string"))
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    candidates = customer.select(key(F.col("c_custkey")).alias("key"), F.concat(F.lit("Customer "), (F.col("c_custkey") % 400).cast("string")).alias("name"))
    held = supplier.select(key(F.col("s_suppkey")).alias("key"), F.concat(F.lit("CUSTOMER-"), (F.col("s_suppkey") + 50).cast("string")).alias("name"))
    more = customer.select(key(F.col("c_custkey") + 1000).alias("key"), F.col("c_name").alias("name"))
    return entities.not_held(candidates, held, more)


# Names in the forms that guessing has to handle, by customer number.
NAMES = ["Troob Capital Management LLC", "Peddock Point Advisors", "The Family Office", "AB & Co", "Red Door"]
GUESS_SQL = {
    0: ["troobcapitalmanagement", "troobcapital", "troob"], 1: ["peddockpointadvisors", "peddockpoint", "peddock"],
    2: ["familyoffice", "family"], 3: [], 4: ["reddoor", "red"],
}


@query(
    "domain_guesses_proof",
    "with g as (" + " union all ".join(f"select {k} as k, '{stem}{e}' as domain, {str(i == 0).lower()} as \"full\", {i * 3 + j} as pos" for k, stems in GUESS_SQL.items() for i, stem in enumerate(stems) for j, e in enumerate([".com", ".net", ".co"])) + """), w as (select * from (values (0, ['troob']), (1, ['peddock', 'point']), (2, []::varchar[]), (4, ['red', 'door'])) t(k, own))
    select c_custkey as crd, domain, "full", len(list_filter(own, lambda w: contains('we are troob of red door city', w))) > 0 and ("full" or c_custkey % 2 = 0) as proven from customer join g on c_custkey % 5 = g.k join w on w.k = g.k where pos < 8""",
)
def domain_guesses_proof(spark, sf):
    k = F.col("c_custkey")
    name = F.element_at(F.array(*map(F.lit, NAMES)), (k % 5 + 1).cast("int"))
    firms = table(spark, sf, "customer").select(k.alias("crd"), name.alias("name"), F.when(k % 2 == 0, "City").otherwise("Elsewhere").alias("city"))
    each = firms.select("*", F.explode(entities.domain_guesses(F.col("name"))).alias("g")).select("*", "g.domain", "g.full")
    proven, _ = entities.domain_proof(F.col("name"), F.lit("We are Troob of Red  Door City"), F.col("full"), F.lit(None).cast("string"), F.col("city"))
    return each.select("crd", "domain", "full", proven.alias("proven"))


@query(
    "fact_diff",
    """select c_custkey as key, c_custkey % 3 = 0 as sectors_changed, c_custkey % 4 = 1 as thesis_changed, (c_custkey % 5 = 0)::int as gone, (c_custkey % 5 = 0)::int as joined, (c_custkey % 7 = 0 and c_custkey % 5 <> 0)::int as retitled from customer""",
)
def fact_diff(spark, sf):
    k = F.col("c_custkey")
    people = lambda name, title: F.create_map(F.lit("Ann Lee"), F.lit("CEO"), name, title)
    base = table(spark, sf, "customer").select(k.alias("key"))
    k = F.col("key")
    old = base.select("key", F.array(F.lit("Estate, Trusts & Philanthropy"), F.lit("Real Estate")).alias("sectors"), F.lit("We invest, patiently.").alias("thesis"), people(F.lit("Bo O. Ray"), F.lit("Sr. VP & CIO")).alias("team"))
    sectors = F.when(k % 3 == 0, F.array(F.lit("Energy"))).otherwise(F.array(F.lit("real estate"), F.lit("Trusts; philanthropy and Estate")))
    thesis = F.when(k % 4 == 1, "We trade.").otherwise("we INVEST patiently")
    who = F.when(k % 5 == 0, "Cy New").otherwise("Bo O Ray")
    title = F.when(k % 7 == 0, "Chairman").otherwise("Senior Vice President and Chief Investment Officer")
    return entities.fact_changes(old, base.select("key", sectors.alias("sectors"), thesis.alias("thesis"), people(who, title).alias("team")))


@query("evidence_spans")
def evidence_spans(spark, sf):
    return pages.spans(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), r"(?i)\b(licen[cs]ed|thing|und)\b")


@query("phrase_counts", r"select doc_id as id, len(regexp_extract_all(text, '(?i)thing|[ou]nd|que')) as n, list_filter(string_split(text, chr(10)), lambda l: l <> '')[1] as first_line from documents")
def phrase_counts(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.regexp_count("text", F.lit("(?i)thing|[ou]nd|que")).alias("n"), F.get(F.filter(F.split("text", "\n"), lambda x: x != ""), 0).alias("first_line"))


FILINGS = [
    "13F-HR      Alpha Family Office LLC                       1001  2026-02-14  edgar/data/1001/a.txt", "13F-HR/A    Alpha Family Office LLC                       1001  2026-02-14  edgar/data/1001/b.txt",
    "13F-HR      Beta Family Wealth, Inc.                      1002  2026-01-31  edgar/data/1002/a.txt", "13F-HR      Beta Family Wealth, Inc.                      1002  2026-04-30  edgar/data/1002/b.txt",
    "10-K        Gamma Corp                                    1003  2026-02-01  edgar/data/1003/a.txt", "13F-HR      Delta Advisers                                1004  2026-02-02  edgar/data/1004/a.txt", "13F-HR broken line",
]


@query("formindex_parse", "select * from (values ('Alpha Family Office LLC', '1001', '2026-02-14', 'edgar/data/1001/a.txt', 'strong'), ('Beta Family Wealth, Inc.', '1002', '2026-04-30', 'edgar/data/1002/b.txt', 'medium')) t(business_name, cik, latest_filing_date, filing_path, tier)")
def formindex_parse(spark, sf):
    from quillon.functions import rules

    path = shared_path(spark, "index")
    spark.createDataFrame([(line,) for line in FILINGS], "value string").coalesce(1).write.text(path)
    filers = feeds.form_filers(feeds.form_index(spark, path))
    name = F.col("business_name")
    tier = F.when(name.rlike(rules.STRONG_NAME), "strong").when(name.rlike(rules.MEDIUM_NAME) | name.rlike(rules.MEDIUM_SHORT), "medium")
    return filers.withColumn("tier", tier).filter("tier is not null")


FIRM_XML = (
    '<Firm><Info FirmCrdNb="S{k}" SECNb="801-{k}" BusNm="{name}" LegalNm="{name} &amp; Co"/><MainAddr Strt1="{k} Main" City="Troy" State="NY" Cntry="United States" PostlCd="12180" PhNb="555-010-{k}"/><Rgstn FirmType="Registered"/>'
    '<Filing Dt="2026-01-31"/><FormInfo><Part1A><Item1><WebAddrs><WebAddr>https://firm{k}.example.com</WebAddr><WebAddr>x</WebAddr></WebAddrs></Item1><Item3A OrgFormNm="Corporation"/><Item5A TtlEmp="{k}"/>{other}<Item5D Q5DA1="1" Q5DB1="two" Q5DB3="{k}000"/><Item5F Q5F2C="{k}000000"/></Part1A></FormInfo></Firm>'
)


@query(
    "xml_feed_scan",
    """select 'S' || s_suppkey as crd, '801-' || s_suppkey as sec_number, s_name as business_name, s_name || ' & Co' as legal_name, 'Corporation' as org_form, 'https://firm' || s_suppkey || '.example.com' as website, s_suppkey || ' Main' as street1, null::varchar as street2,
    'Troy' as city, 'NY' as state, 'United States' as country, '12180' as postal_code, '555-010-' || s_suppkey as phone, s_suppkey as total_employees, s_suppkey * 1000000 as raum_total, null::bigint as hnw_clients, s_suppkey * 1000 as hnw_raum, 1::bigint as nonhnw_clients,
    'Registered' as registration_type, '2026-01-31' as latest_filing_date, case when s_suppkey % 2 = 0 then 'Bill pay | Family office | Tax' else '' end as other_text, 'https://reports.adviserinfo.sec.gov/reports/ADV/S' || s_suppkey || '/PDF/S' || s_suppkey || '.pdf' as source_url from supplier""",
)
def xml_feed_scan(spark, sf):
    """Writes a feed in gzip and plain files, each with a root element, and scans them."""
    path = shared_path(spark, "feed")
    k = F.col("s_suppkey").cast("string")
    other = F.when(F.col("s_suppkey") % 2 == 0, '<Item5B Q5BOth="Bill pay"/><Item5G Q5G12Oth="Family office"/><Item6A Q6AOth="" Q6BOth="Tax"/>').otherwise("")
    marks = {"{k}": k, "{name}": F.col("s_name"), "{other}": other}
    import re

    row = F.concat(*(marks.get(p, F.lit(p)) for p in re.split(r"(\{k\}|\{name\}|\{other\})", FIRM_XML) if p))
    head, tail = F.lit('<?xml version="1.0"?>\n<Firms GenOn="2026">\n'), F.lit("\n</Firms>")
    blocks = table(spark, sf, "supplier").select(row.alias("row"), F.floor(F.col("s_suppkey") / 500).alias("block")).groupBy("block").agg(F.concat(head, F.array_join(F.collect_list("row"), "\n"), tail).alias("value"))
    blocks.filter("block % 2 = 0").select("value").write.option("compression", "gzip").text(f"{path}/zipped")
    blocks.filter("block % 2 = 1").select("value").write.text(f"{path}/plain")
    return feeds.xml_firms(spark, f"{path}/*")


@query("surface_export", "select c_mktsegment as surface, count(*) as n, min(c_name) as first_name, string_agg(distinct n_name, '; ' order by n_name) as states from customer left join nation on c_nationkey = n_nationkey group by 1")
def surface_export(spark, sf):
    """Writes one CSV folder per surface and reads them back."""
    path = shared_path(spark, "surfaces")
    places = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    table(spark, sf, "customer").join(places, "c_nationkey", "left").select("c_custkey", "c_name", "n_name", F.col("c_mktsegment").alias("surface")).write.partitionBy("surface").option("header", True).csv(path)
    back = spark.read.schema("c_custkey long, c_name string, n_name string, surface string").option("header", True).csv(path)
    return back.groupBy("surface").agg(F.count("*").alias("n"), F.min("c_name").alias("first_name"), F.array_join(F.array_sort(F.collect_set("n_name")), "; ").alias("states"))


@query("ledger_export", "select event_type as kind, count(*) as n, sum((props->>'$.k')::int)::bigint as k from events group by 1")
def ledger_export(spark, sf):
    """Dumps the ledger as JSON lines and builds its manifest from what was written."""
    path = shared_path(spark, "ledger")
    table(spark, sf, "events").write.json(path)
    back = feeds.jsonl(spark, path, "event_id long, event_type string, props string")
    return back.groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("int")).alias("k"))


@query("upsert_latest", "select o_custkey as key, max_by(o_orderkey, o_orderkey) as newest from orders where o_orderkey % 3 <> 1 or o_custkey % 2 = 0 group by 1")
def upsert_latest(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey")
    even = orders.filter("key % 2 = 0").groupBy("key").agg(F.max("o_orderkey").alias("newest"))
    old = orders.filter("o_orderkey % 3 <> 1").groupBy("key").agg(F.max("o_orderkey").alias("newest"))
    return keyed.upsert(old, even, ["key"])
