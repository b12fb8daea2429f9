"""Commits: of two writers one wins, readers see whole versions, claims are disjoint; an index that follows its documents."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from quillon.operators import retrieval, storage
from quillon.operators.committed import GONE, LAYERS, Conflict, KeyedTable, Store, claimed, finished
from quillon.operators.maintained import SEGMENTS, MaintainedIndex
from quillon.plans.changes import letters

SHAPE = "k long, v string, n int"


def table(spark, tmp_path, name="t"):
    return KeyedTable(Store(spark, f"file://{tmp_path}"), name, ["k"])


def rows(spark, *values):
    return spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(values)], SHAPE)


def held(t, at=None):
    return sorted(((r.k, r.v) for r in t.read(at).collect()), key=repr)


def test_put_add_remove_and_old_versions(spark, tmp_path):
    t = table(spark, tmp_path)
    with pytest.raises(ValueError, match="nothing has been committed"):
        t.read()
    assert t.remove(rows(spark, (1, "x"))).version == 0
    one = t.put(rows(spark, (1, "a"), (2, "b"), (2, "later"), (None, "null")), F.desc("n"))
    assert held(t) == [(1, "a"), (2, "later"), (None, "null")]
    t.add(rows(spark, (2, "not taken"), (3, "c"), (None, "not taken")), F.asc("n"))
    t.put(rows(spark, (1, "A"), (None, "NULL")), F.asc("n"))
    t.remove(rows(spark, (2, ""), (9, "")))
    assert held(t) == [(1, "A"), (3, "c"), (None, "NULL")]
    t.add(rows(spark, (2, "back")), F.asc("n"))
    assert held(t) == [(1, "A"), (2, "back"), (3, "c"), (None, "NULL")]
    assert held(t, one) == [(1, "a"), (2, "later"), (None, "null")]
    before = held(t)
    t.compact()
    assert len(t.store.snapshot().of("t")) == 1 and held(t) == before and t.layer(t.store.snapshot().of("t")[0]).filter(F.col(GONE)).isEmpty()


def test_many_commits_are_merged(spark, tmp_path):
    t = table(spark, tmp_path)
    for i in range(LAYERS + 2):
        t.put(rows(spark, (i % 3, str(i))), F.asc("n"))
    assert len(t.store.snapshot().of("t")) < LAYERS and held(t) == [(0, "9"), (1, "7"), (2, "8")]
    assert t.store.vacuum(keep=1, older_than=-60) > 0 and held(t) == [(0, "9"), (1, "7"), (2, "8")]


def test_one_of_two_writers_wins(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    base = store.snapshot()
    store.publish(base, {"t": ["first"]})
    with pytest.raises(Conflict):
        store.publish(base, {"t": ["second"]})
    assert store.snapshot().of("t") == ["first"]
    asked = []

    def slow(now):  # another writer commits while this one works
        asked.append(now.version)
        if len(asked) == 1:
            store.publish(now, {"t": [*now.of("t"), "other"]})
        return {"t": [*now.of("t"), "own"]}, {}

    store.change(slow)
    assert asked == [1, 2] and store.snapshot().of("t") == ["first", "other", "own"]


def test_a_killed_write_leaves_the_old_version(spark, tmp_path):
    t = table(spark, tmp_path)
    t.put(rows(spark, (1, "a")), F.asc("n"))

    def killed(now):
        t.store.write(rows(spark, (1, "half")).withColumn(GONE, F.lit(False)))
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        t.store.change(killed)
    assert held(t) == [(1, "a")] and t.store.snapshot().version == 1
    assert t.store.vacuum(older_than=-60) == 1 and held(t) == [(1, "a")]


def test_concurrent_puts_all_arrive(spark, tmp_path):
    t = table(spark, tmp_path)
    t.put(rows(spark, (0, "0")), F.asc("n"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: t.put(rows(spark, (i, str(i))), F.asc("n")), range(1, 5)))
    assert held(t) == [(i, str(i)) for i in range(5)]


def test_claims_are_disjoint_and_leases_end(spark, tmp_path):
    work = KeyedTable(Store(spark, f"file://{tmp_path}"), "queue", ["key"])
    at = dt.datetime(2024, 1, 1)
    state = [(i, "failed" if i % 5 == 0 else "pending", 3 if i == 5 else 0, None, None) for i in range(20)] + [(20, "in_progress", 1, "lost", at), (21, "done", 1, None, None), (22, "pending", None, None, None)]
    work.put(spark.createDataFrame(state, "key long, status string, attempts int, claimed_by string, claimed_at timestamp_ntz"), F.asc("key"))
    now = lambda h: F.lit((at + dt.timedelta(hours=h)).isoformat(" ")).cast("timestamp_ntz")
    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(lambda who: [r.key for r in claimed(work, who, 5, now(0.5)).collect()], "abc"))
    taken = sorted(k for g in got for k in g)
    fresh = [i for i in [*range(20), 22] if i % 5]
    assert all(len(g) == 5 for g in got) and taken == fresh[:15]
    rest = [r.key for r in claimed(work, "d", 50, now(0.5)).collect()]
    assert sorted(rest) == sorted([*fresh[15:], 0, 10, 15])  # 5 failed too often, 20 is still held
    mine = got[0]
    finished(work, "a", spark.createDataFrame([(k, "done") for k in mine] + [(got[1][0], "done")], "key long, status string"))
    after = {r.key: r for r in work.read().collect()}
    assert all(after[k].status == "done" for k in mine) and after[got[1][0]].status == "in_progress" and after[22].attempts == 1
    again = {r.key: r.attempts for r in claimed(work, "e", 50, now(2)).collect()}
    assert set(again) == set(taken + rest + [20]) - set(mine) and again[20] == 2
    assert claimed(KeyedTable(Store(spark, f"file://{tmp_path}/none"), "queue", ["key"]), "a", 1, now(0)) is None


def test_kept_tables_follow_their_files(spark, tmp_path):
    path, built = f"{tmp_path}/docs", []

    def read():
        docs = spark.read.schema(SHAPE).parquet(path)
        return storage.kept(docs, f"test {path}", lambda: built.append(1) or docs.select("k")).count()

    rows(spark, (1, "a")).write.parquet(path)
    assert (read(), read(), len(built)) == (1, 1, 1)
    rows(spark, (2, "b")).write.mode("append").parquet(path)
    assert (read(), len(built)) == (2, 2)


def test_index_equals_a_full_rebuild(spark, tmp_path):
    encoded = []

    def encode(texts):
        encoded.append(sorted(r.id for r in texts.collect()))
        return letters(texts)

    index, words = MaintainedIndex(spark, f"file://{tmp_path}/index", encode), ["red", "green", "blue", "stone", "river", "tree"]
    text = lambda i, e: " ".join(words[(i * k + e) % 6] for k in range(1, 5))
    now = {}
    with pytest.raises(ValueError):
        index.lexical(spark.createDataFrame([(1, "red")], "query long, text string"))
    for epoch in range(SEGMENTS + 3):
        change = {i: text(i, epoch % 3) for i in range(epoch, 40, 3)} | {i: None for i in range(epoch, 60, 11)}
        want = sorted(i for i, c in change.items() if c is not None and now.get(i) != c)
        frame = spark.createDataFrame([(i, c) for i, c in change.items()] + [(0, "aaa")] * (0 in change), "id long, content string")
        for _ in range(2):  # a batch that comes again is passed over
            index.refresh(frame, F.desc("content"), stream="s", epoch=epoch)
        if 0 in change:
            change[0] = max([c for c in (change[0], "aaa") if c])
            want = sorted(i for i, c in change.items() if c is not None and now.get(i) != c)
        now = {k: v for k, v in (now | change).items() if v is not None}
        assert encoded.pop() == want and not encoded
    assert len(index.store.snapshot().of("postings")) <= SEGMENTS
    whole = spark.createDataFrame(list(now.items()), "id long, text string")
    asked = spark.createDataFrame([(1, "red stone"), (2, "rivers"), (3, "aaa"), (4, "nothing"), (5, "")], "query long, text string")
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(index.lexical(asked), retrieval.lexical(retrieval.inverted_index(whole), asked))
    vectors = letters(whole.withColumnRenamed("text", "content"))
    some = vectors.filter("id % 7 = 0").select(F.col("id").alias("query"), "vector")
    assert same(index.dense(some, 5), retrieval.dense(vectors, some, 5))
    old = index.store.snapshot(1)
    assert index.documents(old).count() == sum(1 for i in range(0, 40, 3) if i % 11) + 1
