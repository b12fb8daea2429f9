"""Faults that a review found on larger tables, each on a small one."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillon.functions.text import money_words
from quillon.functions.text import money_words
from quillon.llm import queries as llm_queries
from quillon.operators import admission, entities, ledger, ranking, retrieval, review
from quillon.plans import streams
from quillon.sources import pages
from quillon.streaming import stateful


def test_places_are_broadcast_and_not_the_runs_of_goals(spark):
    goals = spark.range(20).select("id", F.lit("Boston, or St. Louis").alias("text"))
    places = spark.createDataFrame([(p,) for p in ("Boston", "St. Louis", "Rome")], "place string")
    for most in (10, 1):  # known to every task, or too many for that
        got = review.stated_places(goals, places, most=most)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert ("BroadcastHashJoin" in plan and "BuildRight" in plan) if most == 10 else ("SortMergeJoin" in plan)
        assert got.count() == 40


def test_money_is_rounded_by_its_exact_value(spark):
    sums = [622_650_000, 622_750_000, 1_250_000_000, 1_350_000_000, 6_249_950_000_000, 999_999_999, 1_000_000, 5] + [k * 50_000 for k in range(20, 3_000, 7)]
    said = spark.createDataFrame([(n,) for n in sums], "n long").select("n", money_words(F.col("n")).alias("w")).collect()
    assert [(r.n, r.w) for r in said] == [(n, f"${n / 1e9:.1f}B" if n >= 10**9 else f"${n / 1e6:.1f}M" if n >= 10**6 else f"${n}") for n in sums]


def test_dense_search_holds_few_rows_of_each_query():
    """All records are alike, so that each is among the nearest: a task gives n of each query, and those of the least ids."""
    ids, same = np.arange(5000)[::-1], np.ones(8)
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[a : a + 1000]), pa.array([same.tolist()] * 1000)], ["id", "vector"]) for a in range(0, 5000, 1000)]
    near = retrieval._nearest(pa.array([7, 8, 9]), np.ones((3, 8)), 4, pa.int64())
    got = pa.Table.from_batches(near(iter(batches))).to_pylist()
    assert sorted((r["query"], r["id"]) for r in got) == [(q, i) for q in (7, 8, 9) for i in range(4)]
    assert {r["distance"] for r in got} == {1 - 8 / (np.sqrt(8) * np.sqrt(8))}


def test_spans_hold_one_text_at_a_time(spark):
    texts = spark.createDataFrame([(1, "a Licensed  thing\nund so"), (2, None), (3, ""), (4, "thing " * 9)], "id int, text string")
    got = pages.spans(texts, r"(?i)\b(licen[cs]ed|thing|und)\b", around=3, rows=2)
    assert {r.id: r.spans for r in got.collect()} == {1: ["a Licensed t", "d thing un", "ng und so"], 2: [], 3: [], 4: ["thing th", "ng thing th", "ng thing th"]}
    assert "MapInPandas" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_large_domain_is_dealt_into_parts(spark):
    rows = spark.range(300).select(F.col("id").alias("key"), F.when(F.col("id") % 100 > 0, "a").when(F.col("id") > 0, "b").otherwise("c").alias("domain"))
    got = {r.key: (r.domain, r.others) for r in entities.same_domain(rows, share=10).collect()}
    keys = {d: [k for k in range(1, 300) if (k % 100 > 0) == (d == "a")] for d in "ab"}
    assert got == {k: (d, [x for x in own if x != k]) for d, own in keys.items() for k in own}
    plan = entities.same_domain(rows, share=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan and "array_except" not in plan


def test_admission_by_parts_that_wait_for_one_another(spark):
    """One key in eleven parts, whose ends never agree with a fold from nothing, beside keys in one part each."""
    rows = [(0, 7 * i + i % 3, i) for i in range(220)] + [(k, 5 * i, 1000 * n + i) for n, k in enumerate((1, 2, None), 1) for i in range(9)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        got = {r.id: r.admitted for r in admission.admitted(spark.createDataFrame(rows, "key int, at long, id long"), 3, 100, share=20).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {}
    for key in (0, 1, 2, None):
        line, held = sorted((at, i) for k, at, i in rows if k == key), deque(maxlen=3)
        want |= dict(zip((i for _, i in line), admission.fold([at for at, _ in line], held, 3, 100)))
    assert got == want


def test_few_events_are_one_part(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(admission, "_folds", lambda *a, real=admission._folds: asked.append(a) or real(*a))
    admission.admitted(spark.range(50).select(F.lit(0).alias("key"), F.col("id").alias("at"), "id"), 3, 10).count()
    assert len(asked) == 2  # once for the ends, once for the rows


def test_searches_by_blocks_find_what_one_block_finds(spark, monkeypatch):
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    docs = spark.createDataFrame([(i, " ".join(words[(i * j + j // 3) % 5] for j in range(1, 4 + i % 9))) for i in range(60)], "id long, text string")
    asked = spark.createDataFrame([(1, "alpha gamma"), (2, "gamma alpha"), (3, "delta"), (4, "the"), (5, "nothing alpha")], "query int, text string")
    for module, index, search in ((retrieval, retrieval.inverted_index(docs), retrieval.lexical), (ranking, ranking.postings(docs), ranking.ranked)):
        whole = sorted(map(tuple, search(index, asked, 5).collect()))
        monkeypatch.setattr(module, "POSTINGS", 20)
        parts = search(index, asked, 5)
        assert "FlatMapCoGroupsInArrow" in parts._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, parts.collect())) == whole and {r[0] for r in whole} == {1, 2, 3}
        assert [r[1:] for r in whole if r[0] == 1] == [r[1:] for r in whole if r[0] == 2]


def test_streams_keep_state_by_buckets_of_keys(spark, tmp_path):
    """900 keys in 4 buckets: each start adds a few rows to the state store, and the rows given are those of the batch rules."""
    began = dt.datetime(2024, 1, 1)
    values = [(i % 300, "abc"[i % 3], i, began + dt.timedelta(minutes=(37 * i) % 9000), i % 4 or None) for i in range(1800)]
    frame = spark.createDataFrame([*values, (-1, "a", -1, began + dt.timedelta(days=9000), 1)], "key long, field string, id long, ts timestamp, now long")
    for ids in ("id % 2 = 1", "id % 2 = 0 and id >= 0", "id = -1"):
        frame.filter(ids).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stateful.confirmed(spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in"), many=4, delay="30 days")
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 5 * 4
    told = frame.filter("id >= 0").withColumn("past", ledger.history(F.col("now"), ["key", "field"], F.col("ts"), F.col("id")))
    want = {r.id: r.v for r in told.select("id", ledger.oscillation(F.col("past"), F.col("now")).alias("v")).collect()}
    assert {r.id: r.verdict for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()} == want


def test_partitions_of_a_stream_are_given_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with streams.partitions(spark, 2):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_only_postings_that_are_asked_for_meet_the_living(spark):
    index = spark.createDataFrame([(t, i, 1 + i % 2, g) for t in ("alpha", "beta") for i in range(6) for g in ("old", "new")], "term string, id long, tf long, segment string")
    living = spark.createDataFrame([(i, "new" if i % 3 else "old") for i in range(5)], "id long, segment string")
    got = retrieval.lexical(index, spark.createDataFrame([(1, "alpha")], "query int, text string"), 3, living)
    assert [(r.query, r.id, r.rank) for r in got.orderBy("rank").collect()] == [(1, 1, 1), (1, 3, 2), (1, 0, 3)]
    joins = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftSemi" in line]
    assert len(joins) == 2 and "segment" in joins[0] and "term" in joins[1]


def test_planted_passages_go_by_their_bytes_and_clean_texts_stay(spark, tmp_path):
    """Passages of 57 words or more, through the registered query: 400 bytes go wherever they stand, 399 stay."""
    g = np.random.default_rng(11)
    words = lambda n, letters="abcdef": "".join(" " + "".join(g.choice(list(letters), 6 // len(letters[0].encode()))) for _ in range(n))
    whole, accents, long, twice = (words(n, letters) + " " for n, letters in ((57, "abcdef"), (57, "éèàùçô"), (300, "abcdef"), (90, "abcdef")))
    short = words(57)
    assert [len(x.encode()) for x in (whole, accents, short)] == [400, 400, 399]
    marks = iter("ABCDEFGHIJKLMNOPQRSTUVWXYZ")  # on both sides of each passage another letter
    rows, want = [], []
    for i, planted in enumerate([[whole], [whole], [short], [short], [long], [long, whole], [long], [accents], [accents], [twice, twice], []]):
        text = kept = ""
        for passage in [*planted, ""]:
            mark = next(marks)
            own = mark + words(80) + mark
            text, kept = text + own + passage, kept + own + passage * (passage == short)
        rows.append((i, text))
        n, left = len(text.encode()), kept.encode()
        want.append((i, n, n - len(left), len(planted) * (short not in planted), hashlib.sha256(left).hexdigest()))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = llm_queries.QUERIES["op5_suffix_array_dedup"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want
