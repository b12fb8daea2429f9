"""Queries of retrieval and ranking over documents, embeddings and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import dates, search
from quillon.functions.text import words_of
from quillon.operators import keyed, retrieval
from quillon.operators.storage import kept
from quillon.plans.records import cases, table
from quillon.registry import query


def index(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def asked(spark, sf):
    """The query set of searches: every vector whose number is divisible by 50."""
    return table(spark, sf, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))


def documents(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")


DISTANCE_SQL = "d as (select q.vec_id as query, e.vec_id as id, list_cosine_distance(q.embedding::double[], e.embedding::double[]) as distance from embeddings e, embeddings q where q.vec_id % 50 = 0)"
DENSE_SQL = f"{DISTANCE_SQL}, v as (select query, id, row_number() over (partition by query order by distance, id) as rank from d qualify rank <= 20)"
_SINGLE = "case when w like '%sses' then left(w, len(w) - 2) when w like '%ies' and len(w) > 4 then left(w, len(w) - 3) || 'y' when w like '%s' and len(w) > 3 and not regexp_matches(w, '[sui]s$') then left(w, len(w) - 1) else w end"
_STEM = "case when e <> '' and len(s) - len(e) >= 3 then left(s, len(s) - len(e)) else s end"
LEXICAL_SQL = f"""t as (select doc_id as id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '' and not list_contains([{', '.join(map(repr, search.STOPWORDS))}], x))) as w from documents),
u as (select id, {_STEM} as term from (select id, s, regexp_extract(s, '^.*[aeiouy].*[a-z0-9](ing|ed|ly)$', 1) as e from (select id, {_SINGLE} as s from t))), ix as (select term, id, count(*) as tf from u group by 1, 2),
qt as (select query, unnest(list_filter(regexp_split_to_array(lower(said), '[^a-z0-9]+'), lambda x: x <> '' and not list_contains([{', '.join(map(repr, search.STOPWORDS))}], x))) as w from (select doc_id as query, array_to_string(string_split(text, ' ')[3:5], ' ') as said from documents where doc_id % 50 = 0)),
lq as (select distinct query, {_STEM} as term from (select query, s, regexp_extract(s, '^.*[aeiouy].*[a-z0-9](ing|ed|ly)$', 1) as e from (select query, {_SINGLE} as s from qt))), lz as (select query, count(*) as size from lq group by 1),
lh as (select query, id, count(*) as matched, product(tf) as p from ix join lq using (term) group by 1, 2),
l as (select lh.query, id, row_number() over (partition by lh.query order by p desc, id) as rank from lh join lz on lh.query = lz.query where matched = size qualify rank <= 20)"""


def lexical(spark, sf):
    """Three words of every document whose number is divisible by 50, looked for in the index of all documents."""
    docs = documents(spark, sf)
    said = docs.filter("id % 50 = 0").select(F.col("id").alias("query"), F.array_join(F.slice(F.split("text", " "), 3, 3), " ").alias("text"))
    return retrieval.lexical(kept(docs, f"terms of {sf}", lambda: retrieval.inverted_index(docs)), said)


@query("dense_topk", f"with {DENSE_SQL} select query, id, rank from v")
def dense_topk(spark, sf):
    return retrieval.dense(index(spark, sf), asked(spark, sf)).select("query", "id", "rank")


@query("scope_floor", f"with {DISTANCE_SQL} select query, floor(min(distance) * 1e6)::bigint as nearest_millionths, min(distance) <= 0.64 as in_scope from d where id <> query group by query")
def scope_floor(spark, sf):
    others = retrieval.dense(index(spark, sf), asked(spark, sf), 2).filter("id <> query")
    return retrieval.in_scope(others).select("query", F.floor(F.col("nearest") * 1e6).cast("long").alias("nearest_millionths"), "in_scope")


@query("term_index", f"with {LEXICAL_SQL.split('qt as')[0].rstrip().rstrip(',')} select term, count(*) as documents, sum(tf)::bigint as total from ix group by 1")
def term_index(spark, sf):
    return retrieval.inverted_index(documents(spark, sf)).groupBy("term").agg(F.count("*").alias("documents"), F.sum("tf").alias("total"))


@query("lexical_and_rank", f"with {LEXICAL_SQL} select query, id, rank from l")
def lexical_and_rank(spark, sf):
    return lexical(spark, sf).select("query", "id", "rank")


@query(
    "rrf_hybrid",
    f"""with {DENSE_SQL}, {LEXICAL_SQL}, b as (select coalesce(v.query, l.query) as query, coalesce(v.id, l.id) as id, v.rank as v, l.rank as l from v full join l on v.query = l.query and v.id = l.id),
    s as (select *, coalesce(1.0::double / (60 + v), 0) + coalesce(1.0::double / (60 + l), 0) as score from b)
    select query, id, row_number() over (partition by query order by score desc, v nulls last, l nulls last) as rank, case when v is not null and l is not null then 'both' when v is not null then 'vector' else 'lexical' end as matched from s qualify rank <= 10""",
)
def rrf_hybrid(spark, sf):
    return retrieval.fused(retrieval.dense(index(spark, sf), asked(spark, sf)), lexical(spark, sf))


SECTORS = ["healthcare services", "thing", "investment management", "heret"]
FIT_SQL = """m as (select embedding::double[] as q from embeddings where vec_id = 0),
r as (select d.doc_id as id, e.embedding::double[] as v, lower(string_split(text, ' ')[1] || ' ' || coalesce(string_split(text, ' ')[2], '')) as stated, lower(text) as prose, case when l.quality = 1 then 95 when l.quality = 0 then 60 end as conf,
  case d.doc_id % 4 when 0 then 100 when 1 then 60 when 2 then 25 else 0 end as reach, case d.doc_id % 3 when 0 then '2026-02' when 1 then '2025-01-15' end as sig
  from documents d join embeddings e on e.vec_id = d.doc_id left join labels l on l.doc_id = d.doc_id),
c as (select id, greatest(0, 1 - list_cosine_distance(v, q)) as semantic, conf, coalesce(conf, 0) / 100.0::double as c, reach / 100.0::double as r, case when sig is null then 0 when (2026 - sig[1:4]::int) * 12 + 6 - sig[6:7]::int <= 12 then 1 when (2026 - sig[1:4]::int) * 12 + 6 - sig[6:7]::int <= 24 then 0.5 else 0 end as signals,
  [case when contains(stated, 'healthcare') then 1 when contains(prose, 'healthcare') then 0.5 else 0 end, case when contains(stated, 'thing') then 1 when contains(prose, 'thing') then 0.5 else 0 end, case when contains(stated, 'heret') then 1 when contains(prose, 'heret') then 0.5 else 0 end]::double[] as hits, prose from r, m),
f as (select *, least(1, list_sum(hits) / 3) as sector, list_max(hits) = 1 as stated, list_max(hits) > 0 as hit from c),
g as (select id, 0.35::double * semantic + 0.25::double * sector + 0.15::double * c + 0.15::double * r + 0.10::double * signals as score, case when stated and c >= 0.9 then 'strong' when hit then 'moderate' when prose <> '' and semantic >= 0.45 then 'weak' else 'insufficient_evidence' end as tier from f)"""


@query("fit_rank", f"with {FIT_SQL} select id, tier, floor(score * 1e6)::bigint as score_millionths from g where id <> 0 order by score desc, id limit 24")
def fit_rank(spark, sf):
    stated = F.concat_ws(" ", F.get(F.split("text", " "), 0), F.coalesce(F.get(F.split("text", " "), 1), F.lit("")))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), stated.alias("sectors"), F.col("text").alias("prose"))
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, 95).when(F.col("quality") == 0, 60).alias("confidence"))
    k = F.col("id")
    records = index(spark, sf).filter("id <> 0").join(docs, "id").join(labels, "id", "left").withColumns({"reachability": cases(k % 4, [(0, 100), (1, 60), (2, 25)], 0), "signal_date": cases(k % 3, [(0, "2026-02"), (1, "2025-01-15")])})
    mandate = [float(x) for x in (index(spark, sf).filter("id = 0").first() or [0, []])[1]]
    ranked = retrieval.fit(records, mandate, SECTORS, F.lit("2026-06-30").cast("date"))
    return keyed.top(ranked, 24, F.desc("score"), F.asc("id")).select("id", "tier", F.floor(F.col("score") * 1e6).cast("long").alias("score_millionths"))


@query("fit_unranked", "select count(*) as unranked from documents where not exists (select 1 from embeddings where vec_id = doc_id)")
def fit_unranked(spark, sf):
    return documents(spark, sf).join(index(spark, sf), "id", "left_anti").agg(F.count("*").alias("unranked"))


@query(
    "index_incremental_diff",
    """select coalesce(n.doc_id, o.doc_id) as id, case when n.doc_id is null then 'drop' when o.doc_id is null then 'add' when n.text = o.text then 'keep' else 'embed' end as change
    from (select * from documents where doc_id % 11 <> 0) n full join (select doc_id, case when doc_id % 7 = 0 then text || '.' else text end as text from documents where doc_id % 5 <> 0) o on n.doc_id = o.doc_id""",
)
def index_incremental_diff(spark, sf):
    docs = documents(spark, sf).withColumnRenamed("text", "content")
    old = docs.filter("id % 5 <> 0").withColumn("content", F.when(F.col("id") % 7 == 0, F.concat("content", F.lit("."))).otherwise(F.col("content")))
    return retrieval.index_changes(old, docs.filter("id % 11 <> 0"))


EMAIL_SQL = "'[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}'"


@query(
    "grounding_email_anti",
    f"""with e as (select distinct doc_id as id, source, lower(unnest(regexp_extract_all(text, {EMAIL_SQL}))) as email from documents)
    select id, email from e where not exists (select 1 from e a where a.source in ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6') and a.email = e.email)""",
)
def grounding_email_anti(spark, sf):
    from quillon.functions.text import emails_in

    docs = table(spark, sf, "documents")
    trusted = docs.filter(F.col("source").isin(*(f"src{i}" for i in range(7)))).select(F.explode(emails_in(F.col("text"))).alias("email"))
    return retrieval.ungrounded_emails(documents(spark, sf), trusted)


CLAIM = "case doc_id % 4 when 0 then 'There are 12 family offices here.' when 1 then 'A total of **7** and 12 records match.' when 2 then 'Found 12. 3. No list.' else text end"


@query(
    "count_claim_check",
    rf"""with a as (select doc_id as id, lower({CLAIM}) as t from documents)
    select id, list_filter(list_concat(regexp_extract_all(t, '\b(\d{{1,3}})\s+(?:\*\*)?(?:family off|multi-family|record|firm|result|match)', 1), regexp_extract_all(t, '(?:there are|a total of|count of|found)\s+(?:\*\*)?(\d{{1,3}})', 1)), lambda x: x::int <> 12)::int[] as wrong from a""",
)
def count_claim_check(spark, sf):
    k = F.col("id")
    said = cases(k % 4, [(0, "There are 12 family offices here."), (1, "A total of **7** and 12 records match."), (2, "Found 12. 3. No list.")])
    answers = documents(spark, sf).select("id", F.coalesce(said, F.col("text")).alias("text"))
    return answers.select("id", F.filter(retrieval.count_claims(F.col("text")), lambda n: n != 12).alias("wrong"))


@query(
    "document_rule_confusion",
    """with p as (select l.quality as truth, (len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) >= 100 and not contains(text, '###'))::int as predicted from labels l join documents d using (doc_id)),
    c as (select count(*) filter (where truth = 1 and predicted = 1) as tp, count(*) filter (where truth = 0 and predicted = 1) as fp, count(*) filter (where truth = 1 and predicted = 0) as fn, count(*) filter (where truth = 0 and predicted = 0) as tn from p)
    select *, tp / nullif(tp + fp, 0) as precision, tp / nullif(tp + fn, 0) as recall, fp / nullif(fp + tn, 0) as fpr, (tp + tn) / nullif(tp + fp + fn + tn, 0) as accuracy from c""",
)
def document_rule_confusion(spark, sf):
    rule = (F.size(words_of(F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", " "))) >= 100) & ~F.contains("text", F.lit("###"))
    judged = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id").select(F.col("quality").alias("truth"), rule.cast("int").alias("predicted"))
    return retrieval.confusion(judged)


@query("bucket_crosstab", "select d.lang as bucket, count(*) filter (where toxic = 1) as toxic, count(*) filter (where toxic = 0) as clean, count(*) filter (where toxic is null) as unreviewed from documents d left join labels l using (doc_id) group by 1")
def bucket_crosstab(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.groupBy(F.col("lang").alias("bucket")).agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic").isNull()).alias("unreviewed"))


@query(
    "intent_routing",
    r"""select item_id, case when regexp_matches(lower(t), '\b(how many|count|total number|list all)\b') then 'aggregate' when regexp_matches(lower(t), '\b(who is|tell me about|contact for|details on)\b') then 'lookup' else 'discovery' end as intent
    from (select item_id, case item_id % 3 when 0 then 'How many firms are there?' when 1 then 'Tell me about the first.' else text end as t from benchmark)""",
)
def intent_routing(spark, sf):
    t = F.coalesce(cases(F.col("item_id") % 3, [(0, "How many firms are there?"), (1, "Tell me about the first.")]), F.col("text"))
    return table(spark, sf, "benchmark").select("item_id", retrieval.intent(t).alias("intent"))


@query("signal_recency", "select doc_id, case when s is null then 0.0 when m <= 12 then 1.0 when m <= 24 then 0.5 else 0.0 end::double as recency, m as months from (select doc_id, s, (2026 - s[1:4]::int) * 12 + 6 - s[6:7]::int as m from (select doc_id, case doc_id % 4 when 0 then '2026-02' when 1 then '2025-01-15' when 2 then '2019-12' end as s from documents))")
def signal_recency(spark, sf):
    s, today = cases(F.col("doc_id") % 4, [(0, "2026-02"), (1, "2025-01-15"), (2, "2019-12")]), F.lit("2026-06-30").cast("date")
    return table(spark, sf, "documents").select("doc_id", dates.recency(s, today).alias("recency"), dates.months_since(s, today).alias("months"))
