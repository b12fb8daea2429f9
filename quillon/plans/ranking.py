"""Queries of lexical search with stems and positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import porter
from quillon.functions.search import STOPWORDS
from quillon.operators import ranking
from quillon.plans.records import table
from quillon.plans.retrieval import documents
from quillon.registry import query


def _longest(rules: dict[str, str]) -> str:
    return "case " + " ".join(f"when w like '%{s}' then {rules[s]}" for s in sorted(rules, key=lambda s: -len(s))) + " else w end"


def _swap(table_: dict[str, str], region: dict[str, str], also: dict[str, str]) -> str:
    fits = lambda s: f"length(w) - {len(s)} >= {region.get(s, region[''])}" + (f" and {also[s]}" if s in also else "")
    return _longest({s: f"case when {fits(s)} then left(w, length(w) - {len(s)}) || '{to}' else w end" for s, to in table_.items()})


def stems_sql(words: str) -> str:
    """CTEs that end in stems (word, stem): the published rules over the distinct words of a table."""
    quoted = lambda xs: ", ".join(f"'{x}'" for x in xs)
    ie = "case when length(w) > 4 then left(w, length(w) - 2) else left(w, length(w) - 1) end"
    plural = _longest({"sses": "left(w, length(w) - 2)", "ied": ie, "ies": ie, "us": "w", "ss": "w", "s": "case when regexp_matches(left(w, length(w) - 2), '[aeiouy]') then left(w, length(w) - 1) else w end"})
    short = lambda t: f"regexp_matches({t}, '{porter.SHORT}')"
    return rf"""p0 as materialized (select distinct word, regexp_replace(word, '(^|[aeiouy])y', '\1Y', 'g') as w from {words}),
p1 as materialized (select *, length(regexp_extract(w, '^({"|".join(porter.PREFIXES)})')) as fixed, length(regexp_extract(w, '{porter.REGION}')) as found from p0),
p2 as materialized (select word, w, case when fixed > 0 then fixed when found > 0 then found else length(w) end as r1 from p1),
p3 as materialized (select *, length(regexp_extract(substr(w, r1 + 1), '{porter.REGION}')) as found from p2),
p4 as materialized (select word, {plural} as w, r1, case when found > 0 then r1 + found else length(w) end as r2 from p3),
p5 as materialized (select *, case when regexp_matches(w, '[aeiouy].*(ing|ed)(ly)?$') and not regexp_matches(w, 'eed(ly)?$') then regexp_replace(w, '(ing|ed)(ly)?$', '') else '' end as cut from p4),
p6 as materialized (select word, r1, r2, case when w in ({quoted(porter.DONE_AFTER_PLURAL)}) then w end as done,
  case when cut = '' then {_swap({"eed": "ee", "eedly": "ee"}, {"": "r1"}, {})} when regexp_matches(cut, '(at|bl|iz)$') then cut || 'e' when regexp_matches(cut, '{porter.DOUBLE}') then left(cut, length(cut) - 1)
    when {short("cut")} and length(cut) <= r1 then cut || 'e' else cut end as w from p5),
p7 as materialized (select word, r1, r2, done, case when regexp_matches(w, '.[^aeiouy][yY]$') then left(w, length(w) - 1) || 'i' else w end as w from p6),
p8 as materialized (select word, r1, r2, done, {_swap(porter.STEP2, {"": "r1"}, {"ogi": "w like '%logi'", "li": f"regexp_matches(w, '{porter.LI_ENDING}')"})} as w from p7),
p9 as materialized (select word, r1, r2, done, {_swap(porter.STEP3, {"": "r1", "ative": "r2"}, {})} as w from p8),
p10 as materialized (select word, r1, r2, done, {_swap(dict.fromkeys(porter.STEP4, ""), {"": "r2"}, {"ion": "regexp_matches(w, '[st]ion$')"})} as w from p9),
p11 as materialized (select word, done, case when (w like '%e' and (length(w) - 1 >= r2 or (length(w) - 1 >= r1 and not {short("left(w, length(w) - 1)")}))) or (w like '%ll' and length(w) - 1 >= r2) then left(w, length(w) - 1) else w end as w from p10),
stems as materialized (select word, case when length(word) <= 2 then word else coalesce(map {{{", ".join(f"'{a}': '{b}'" for a, b in porter.IRREGULAR.items())}}}[word], lower(coalesce(done, w))) end as stem from p11)"""


STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
SAID = "array_to_string(string_split(text, ' ')[3:4], ' ')"
RANKED_SQL = f"""with said as (select doc_id as id, regexp_extract_all(lower(text), '[a-z0-9]+') as ws from documents),
w as (select id, pos, ws[pos] as word from (select id, ws, unnest(generate_series(1, len(ws))) as pos from said) where ws[pos] not in ({STOP})),
qs as (select doc_id as query, regexp_extract_all(lower({SAID}), '[a-z0-9]+') as ws from documents where doc_id % 50 = 0),
q as (select query, unnest(ws) as word from qs), every as (select word from w union select word from q where word not in ({STOP})),
{stems_sql("every")},
t as (select id, pos, stem as term from w join stems using (word)), asked as (select distinct query, stem as term from q join stems using (word)), sizes as (select query, count(*) as size from asked group by 1),
h as (select query, id, term, count(*) as times from t join asked using (term) group by all),
f as (select query, id, size, max(times) as times from h join sizes using (query) group by all having count(*) = size),
p as (select f.query, f.id, sum(ln(1 - 0.1 * sqrt(1 / (1.005 + 0.05 * exp(abs(a.pos - b.pos) / 1.5 - 2))))) as missed from f join asked x on x.query = f.query join asked y on y.query = f.query and x.term < y.term
  join t a on a.id = f.id and a.term = x.term join t b on b.id = f.id and b.term = y.term and abs(a.pos - b.pos) <= 100 group by all),
s as (select f.query, f.id, length, case when size = 1 then 0.1 / 1.64493406685 * list_sum(list_transform(generate_series(1, times), lambda j: 1.0 / (j * j))) else coalesce(1 - exp(missed), 0) end as score
  from f left join p on f.query = p.query and f.id = p.id join (select id, len(ws) as length from said) l on l.id = f.id)"""


@query(
    "ranked_search",
    f"""{RANKED_SQL}, e as (select 'plain' as kind, query, id, round(score * 1e6) as score from s union all select 'by length', query, id, round(score / (1 + ln(length)) * 1e6) from s)
    select kind, query, id, row_number() over (partition by kind, query order by score desc, id) as rank, score::bigint // 10 as score from e qualify rank <= 20""",
)
def ranked_search(spark, sf):
    """Two words of every document whose number is divisible by 50, looked for in all documents; with and without regard to length."""
    docs = documents(spark, sf)
    said = docs.filter("id % 50 = 0").select(F.col("id").alias("query"), F.array_join(F.slice(F.split("text", " "), 3, 2), " ").alias("text"))
    kind, score = F.when(F.col("by_length"), "by length").otherwise("plain"), F.floor(F.round(F.col("score") * 1e6) / 10).cast("long")
    return ranking.ranked_texts(docs, said, 20).select(kind.alias("kind"), "query", "id", "rank", score.alias("score"))


@query(
    "stemmed_vocabulary",
    f"""with every as (select distinct unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from (select text from documents union all select name from items union all select text from benchmark)), {stems_sql("every")}
    select stem, count(*) as words, min(word) as first from stems group by 1""",
)
def stemmed_vocabulary(spark, sf):
    texts = table(spark, sf, "documents").select("text").union(table(spark, sf, "items").select("name")).union(table(spark, sf, "benchmark").select("text"))
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    return porter.stems(words).groupBy("stem").agg(F.count("*").alias("words"), F.min("word").alias("first"))
