"""Queries over tables that are changed by commits: a change feed, claims, and the index that follows its documents."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.committed import GONE, KeyedTable, Store, claimed, finished
from quillon.operators.keyed import latest
from quillon.operators.maintained import MaintainedIndex
from quillon.operators.storage import shared_path
from quillon.plans.records import table
from quillon.plans.retrieval import LEXICAL_SQL
from quillon.registry import query

FEED = "client_id, source, segment, city, balance"


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of clients, each once, in one order for each client: by time, then number, then id."""
    return latest(table(spark, sf, "client_changes").filter("client_id is not null and valid_at is not null"), ["change_id"], F.desc("valid_at"))


@query(
    "committed_clients",
    f"""with c as (select distinct on (change_id) * from client_changes where client_id is not null and valid_at is not null order by change_id, valid_at desc),
    n as (select distinct on (client_id) * from c order by client_id, valid_at desc, seq desc, change_id desc)
    select {FEED} from clients where client_id not in (select client_id from n) union all select {FEED} from n where op <> 'D'""",
)
def committed_clients(spark, sf):
    """The clients, and the feed applied in three commits by time: what is changed last in each is put, what is deleted goes."""
    clients = KeyedTable(Store(spark, shared_path(spark, "clients")), "clients", ["client_id"])
    clients.put(table(spark, sf, "clients").select(*FEED.split(", "), F.col("updated_at").alias("at")), F.desc("at"))
    changes = feed(spark, sf)
    for start, stop in (("2000-01-01", "2024-02-01"), ("2024-02-01", "2024-04-01"), ("2024-04-01", "2100-01-01")):
        part = changes.filter((F.col("valid_at") >= start) & (F.col("valid_at") < stop))
        newest = latest(part, ["client_id"], F.desc("valid_at"), F.desc("seq"), F.desc("change_id"))
        clients.change(lambda held, rows=newest: rows.select(*FEED.split(", "), F.col("valid_at").alias("at"), (F.col("op") == "D").alias(GONE)))
    return clients.read().drop("at")


@query(
    "committed_claims",
    """with q as (select sale_id as key, case status when 'open' then 'pending' when 'held' then 'failed' else 'done' end as status, coalesce(priority, 0) % 5 as attempts from sales),
    r as (select *, row_number() over (order by status = 'failed', key) as n from q where status = 'pending' or (status = 'failed' and attempts < 3))
    select key, case when n > 80 then 'in_progress' when key % 3 = 0 then 'failed' else 'done' end as status, attempts + 1 as attempts, case when n > 80 then 0 else 1 end::bigint as workers from r where n <= 120""",
)
def committed_claims(spark, sf):
    """Two workers claim 40 sales each at one time and finish them, a third claims 40 more; workers: how many of the two got a row."""
    kind = F.when(F.col("status") == "open", "pending").when(F.col("status") == "held", "failed").otherwise("done")
    rows = table(spark, sf, "sales").select(F.col("sale_id").alias("key"), kind.alias("status"), (F.coalesce("priority", F.lit(0)) % 5).alias("attempts"))
    work = KeyedTable(Store(spark, shared_path(spark, "queue")), "queue", ["key"])
    work.put(rows.withColumns({"claimed_by": F.lit(None).cast("string"), "claimed_at": F.lit(None).cast("timestamp_ntz")}), F.asc("status"))
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    with ThreadPoolExecutor(2) as both:
        one, two = both.map(lambda who: claimed(work, who, 40, now), ("a", "b"))
    done = F.when(F.col("key") % 3 == 0, "failed").otherwise("done")
    for who, got in (("a", one), ("b", two)):
        finished(work, who, got.select("key", done.alias("status")))
    claimed(work, "c", 40, now)
    got = one.union(two).groupBy("key").agg(F.count("*").alias("workers"))
    return work.read().filter("claimed_by is not null").join(got, "key", "left").select("key", "status", "attempts", F.coalesce("workers", F.lit(0)).alias("workers"))


LETTERS = "entisrao"
VECTOR_SQL = "[" + ", ".join(f"(length(content) - length(replace(content, '{c}', '')))::double" for c in LETTERS) + "]"
FINAL_SQL = """documents_now as (select doc_id, case when doc_id % 17 = 0 then coalesce(text, '') || ' zebra' else coalesce(text, '') end as content from documents
  where not (doc_id % 13 = 0 and doc_id % 26 <> 0 and doc_id % 17 <> 0))"""


def letters(texts: DataFrame) -> DataFrame:
    """A stand-in for an encoder: how often some letters stand in a text."""
    return texts.select("id", F.array(*((F.length("content") - F.length(F.replace("content", F.lit(c), F.lit("")))).cast("double") for c in LETTERS)).alias("vector"))


def batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three batches of changes: most documents, some in an older form; the rest, edits and deletions; repeats, edits and returns."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("content"))
    k, content = F.col("id"), F.col("content")
    return [
        docs.filter(k % 11 != 0).withColumn("content", F.when(k % 7 == 0, F.concat(content, F.lit(" older"))).otherwise(content)),
        docs.filter((k % 11 == 0) | (k % 7 == 0) | (k % 13 == 0)).withColumn("content", F.when(k % 13 != 0, content)),
        docs.filter(((k % 5 == 0) & (k % 13 != 0)) | (k % 17 == 0) | (k % 26 == 0)).withColumn("content", F.when(k % 17 == 0, F.concat(content, F.lit(" zebra"))).otherwise(content)),
    ]


@query(
    "maintained_index",
    f"""with {FINAL_SQL}, {LEXICAL_SQL.replace("doc_id as id, unnest(list_filter(regexp_split_to_array(lower(text)", "doc_id as id, unnest(list_filter(regexp_split_to_array(lower(content)").replace(" from documents),", " from documents_now),", 1)},
    v as (select doc_id as id, {VECTOR_SQL} as v from documents_now), w as (select *, list_dot_product(v, v) as own from v),
    d as (select q.id as query, e.id, row_number() over (partition by q.id order by 1 - list_dot_product(e.v, q.v) / (sqrt(e.own) * sqrt(q.own)), e.id) as rank from w e, w q where q.id % 50 = 0 and e.own > 0 and q.own > 0 qualify rank <= 10),
    c as (select doc_id as k, doc_id % 7 = 0 as old, coalesce(text, '') as t from documents)
    select 'lexical' as kind, query, id, rank from l union all select 'dense', query, id, rank from d
    union all select 'encoded', 1, count(*), null from c where k % 11 <> 0
    union all select 'encoded', 2, count(*), null from c where k % 13 <> 0 and (k % 11 = 0 or old)
    union all select 'encoded', 3, count(*), null from c where k % 17 = 0 or k % 26 = 0""",
)
def maintained_index(spark, sf):
    """The index after three batches that a stream brings in two starts: searches, and how many documents each commit encoded."""
    index = MaintainedIndex(spark, shared_path(spark, "index"), letters)
    arriving, seen = shared_path(spark, "arriving"), shared_path(spark, "index-state")
    encoded = []
    for part in batches(spark, sf):
        part.write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(part.schema).parquet(arriving)
        index.follow(stream, "documents", seen, F.desc("content")).awaitTermination()
        encoded.append(index.store.snapshot().notes["encoded"])
    docs = table(spark, sf, "documents")
    said = docs.filter("doc_id % 50 = 0").select(F.col("doc_id").alias("query"), F.array_join(F.slice(F.split("text", " "), 3, 3), " ").alias("text"))
    asked = index.documents().filter("id % 50 = 0").filter(F.exists("vector", lambda x: x > 0)).select(F.col("id").alias("query"), "vector")
    counts = spark.createDataFrame([("encoded", n, k) for n, k in enumerate(encoded, 1)], "kind string, query long, id long").withColumn("rank", F.lit(None).cast("int"))
    shown = [leg.select(F.lit(kind).alias("kind"), "query", "id", "rank") for kind, leg in (("lexical", index.lexical(said)), ("dense", index.dense(asked, 10)))]
    return shown[0].unionByName(shown[1]).unionByName(counts)
