"""Faults that a review found on larger tables, each on a small one."""

from __future__ import annotations

import pyarrow as pa

from quillon.operators import ranking, retrieval


def test_search_over_texts_finds_what_the_index_finds_and_shuffles_no_postings(spark):
    words = ["alpha", "betas", "GAMMA", "delta", "the", "omega", "beta", "é"]
    rows = [(i, " ".join(words[(i * j + j // 3) % 8] for j in range(1, 4 + i % 37))) for i in range(700)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, " alpha"), (None, "alpha delta")], "id long, text string")
    asked = spark.createDataFrame([(1, "alpha gamma"), (2, "gamma alpha"), (3, "delta"), (4, "the"), (5, "nothing alpha"), (6, "beta omega delta"), (7, None)], "query int, text string")
    got = ranking.ranked_texts(docs, asked, 5)
    known = docs.filter("id is not null")
    index, want = ranking.postings(known), []
    for by_length, sizes in ((False, None), (True, ranking.lengths(known))):
        want += [(by_length, *r) for r in ranking.ranked(index, asked, 5, sizes).select("query", "id", "score", "rank").collect()]
    found = sorted(map(tuple, got.select("by_length", "query", "id", "score", "rank").collect()))
    assert found == sorted(want) and {r[1] for r in found} == {1, 2, 3, 6}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "positions" not in plan and "posexplode" not in plan


def test_blocks_of_texts_keep_the_best_of_each_set(monkeypatch):
    """Texts in many blocks, whose best come last, give what one block gives; only n rows of a set are given out."""
    texts = [(i, "one " * (1 + i // 9) + "x " * (i % 5) + "two" * (i % 3 > 0)) for i in range(300)]
    names, kinds = ["side", "own", "terms", "word", "term", "id", "text"], [pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.string()]
    rows = [(0, 7, ["one"], None, None, None, None), (0, 8, ["one", "two"], None, None, None, None), (0, 9, ["none"], None, None, None, None)]
    rows += [(1, None, None, w, w, None, None) for w in ("one", "two")] + [(2, None, None, None, None, i, t) for i, t in texts]
    table = pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def best():
        return sorted(tuple(r.values()) for b in ranking._found(4, pa.int32(), pa.int64())(iter(table.to_batches(max_chunksize=50))) for r in b.to_pylist())

    whole = best()
    monkeypatch.setattr(ranking, "PLACES", 100)
    monkeypatch.setattr(retrieval, "BYTES", 64)
    assert best() == whole and len(whole) == 2 * 2 * 4
    assert {r[2] for r in whole if r[0] is False and r[1] == 7} == {297, 298, 299, 288}


def test_more_queries_than_a_matrix_are_streamed_in_chunks(spark, monkeypatch):
    """Queries in several chunks give what one matrix gives; zero and null vectors, which have no distance, are passed over."""
    vector = lambda i: [float((i * k) % 11 - 5) for k in range(1, 6)] + [1.0]
    rows = [(i, vector(i)) for i in range(120)] + [(200, [0.0] * 6), (201, None), (202, []), (203, [1.0, 2.0])]
    index = spark.createDataFrame(rows, "id long, vector array<double>")
    asked = index.filter("id % 3 = 0 and id < 120 or id = 203").withColumnRenamed("id", "query")
    some = lambda: sorted(map(tuple, retrieval.dense(index, asked, 4).select("query", "id", "distance", "rank").collect()))
    whole = some()
    monkeypatch.setattr(retrieval, "MATRIX", 7)
    monkeypatch.setattr(retrieval, "PARTS", 3)
    assert some() == whole and len(whole) == 40 * 4 + 1
    plan = retrieval.dense(index, asked, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan


def test_texts_with_ids_of_their_own_are_indexed_without_a_shuffle(spark, monkeypatch):
    said = ["Reports, report reported THE report", None, "", "-- ,", "a1 a1\tthings\u00e9thing \u0130x", "stories story studied ies bus"]
    rows = [(i if i != 13 else None, said[i % 6] and said[i % 6] + " word" * (i % 4)) for i in range(40)]
    docs = spark.createDataFrame(rows, "id long, text string")
    got = retrieval.index_of_texts(docs)
    assert sorted(map(str, got.select("term", "id", "tf").collect())) == sorted(map(str, retrieval.inverted_index(docs).collect()))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    # A text may go on in the next batch, and a batch may be split anywhere.
    monkeypatch.setattr(retrieval, "BYTES", 8)
    texts = pa.record_batch({"id": [1, 2, 3], "text": ["b a b c", None, "a" * 20 + " b b"]})
    parts = [b.slice(i, 1) for b in retrieval._counted(iter([texts])) for i in range(len(b))]
    parts = [p.rename_columns(["id", "term", "n"]) for p in parts]
    out = [tuple(r.values()) for b in retrieval._gathered(iter([*parts, parts[0].slice(1)])) for r in b.to_pylist()]
    assert sorted(out) == [("a", 1, 1), ("a" * 20, 3, 1), ("b", 1, 2), ("b", 3, 2), ("c", 1, 1)]
