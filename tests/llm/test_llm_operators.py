"""Operators for training text on small tables: brute force, round trips, edge cases."""

import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import anchors, language, lines, mixing, packing, quality, queries, substring, suffix, toxicity, vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, size string, target int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t) if t else None, "clash", 1) for i, t, s in rows], SHAPE)


def passages(seed=1, n=40):
    """Texts with shared passages, repeats inside a text, copies, and none."""
    g = random.Random(seed)
    word = lambda: "".join(g.choice("abcdeé") for _ in range(g.randint(1, 5)))
    shared = [" ".join(word() for _ in range(k)) for k in (19, 20, 21, 60)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(g.randint(0, 6)):
            parts.append(g.choice(shared) if g.random() < 0.5 else " ".join(word() for _ in range(g.randint(1, 30))))
        rows.append(g.choice([" ", "\n", "\t "]).join(parts))
    rows += ["the the the " * 30, "", None, rows[0], rows[1], "x"]
    return [(i, t, f"s{i % 3}") for i, t in enumerate(rows)]


def brute_words(rows, w):
    seen, out = set(), {}
    for i, t, _ in rows:
        ws = WORD.findall(t or "")
        gone = set()
        for j in range(len(ws) - w + 1):
            key = tuple(ws[j : j + w])
            gone |= set(range(j, j + w)) if key in seen else set()
            seen.add(key)
        out[i] = (len(ws), len(gone), " ".join(x for j, x in enumerate(ws) if j not in gone))
    return out


def brute_bytes(rows, w):
    count, out = {}, {}
    for _, t, _ in rows:
        b = (t or "").encode()
        for j in range(len(b) - w + 1):
            count[b[j : j + w]] = count.get(b[j : j + w], 0) + 1
    for i, t, _ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - w + 1):
            if count[b[j : j + w]] > 1:
                gone[j : j + w] = True
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_substrings(spark, monkeypatch, hot):
    if hot:  # every anchor in two surroundings goes the way of the large groups
        monkeypatch.setattr(anchors, "LOCAL_HOT", 0)
        monkeypatch.setattr(anchors, "GROUP", 1)
    rows = passages()
    got = {r.doc_id: (r.n_units, sum(s.stop - s.start for s in r.spans), r.kept) for r in substring.dedup_substrings(docs(spark, rows).repartition(3), 20).collect()}
    assert got == brute_words(rows, 20)


@pytest.mark.parametrize("hot", [False, True])
def test_bytes(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(anchors, "LOCAL_HOT", 0)
        monkeypatch.setattr(anchors, "GROUP", 1)
    rows = passages(2)
    got = {r.doc_id: (r.n_units, sum(s.stop - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in suffix.dedup_bytes(docs(spark, rows).repartition(3), 40).collect()}
    assert got == brute_bytes(rows, 40)


def test_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(30))
    df = docs(spark, [(1, long, "a"), (1, long, "a"), (None, long, "a"), (2, None, None)])
    first = sorted(((r.doc_id, len(r.kept.split())) for r in substring.dedup_substrings(df).collect()), key=str)
    assert first == sorted([(1, 0), (1, 0), (None, 30), (2, 0)], key=str)
    assert sorted(len(r.kept) for r in suffix.dedup_bytes(df, 40).collect()) == [0, 0, 0, 0]
    for empty in (substring.dedup_substrings(df.limit(0)), suffix.dedup_bytes(df.limit(0))):
        assert empty.count() == 0


def test_suffix_order():
    g = np.random.default_rng(0)
    for _ in range(200):
        s = g.integers(0, g.integers(1, 5), g.integers(1, 120))
        assert suffix.suffix_order(s, 8).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_queue_spills():
    q = suffix.BucketQueue(3, limit=4)
    for block in ([1, 2], [3, 4, 5], [6]):
        q.push(1, np.array(block))
    assert q.file is not None and q.pop(1).tolist() == [1, 2, 3, 4, 5, 6] and not len(q.pop(1))
    q.close()


def test_automaton():
    a = substring.SuffixAutomaton()
    a.add("abcab")
    a.add("cabx")
    assert list(a.matches("zcabxab")) == [0, 1, 2, 3, 4, 1, 2]


def test_lines(spark):
    block = "Alpha one\n\n beta  TWO\ngamma 3"
    rows = [(3, block + "\nown", "a"), (1, "x\n" + block, "a"), (2, block, None), (4, None, "a"), (5, "", "a"), (6, "one\ntwo", "a"), (7, "one\ntwo", "a"), (None, block, "a"), (8, "p\nq\nr\ns\np\nq\nr", "a")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(docs(spark, rows)).collect()}
    assert got == {None: (block, 4, 0), 1: ("x", 5, 4), 2: ("", 4, 4), 3: ("own", 5, 4), 4: (None, 0, 0), 5: ("", 1, 0), 6: ("one\ntwo", 2, 0), 7: ("one\ntwo", 2, 0), 8: ("p\nq\nr\ns", 7, 3)}
    assert lines.dedup_lines(docs(spark, rows).limit(0)).count() == 0


def test_quality_base_and_lines(spark):
    many = ["abcdefgh"[i] + "x" * j for i in range(8) for j in range(60)]  # digits are evened out, letters are not
    rows = [(i, f"Common line {i % 10} here\n" + " ".join(many[60 * i : 60 * i + 60]), "h") for i in range(8)] + [(20, "a b c a b c", "h"), (21, None, None), (22, "x y z " * 40, "h"), (23, "a#b $ c\n\nq\nq\n q", None)]
    got = {r.doc_id: r for r in quality.quality(docs(spark, rows), limit=5).collect()}
    assert got[0].n_frequent_words == 4 and got[0].kept and not got[0].base_failed
    assert (got[20].n_words, got[20].n_repeat_words, got[20].base_failed) == (6, 6, True)
    assert (got[21].n_words, got[21].word_chars, got[21].kept) == (0, 0, False)
    assert (got[22].n_repeat_words, got[22].base_failed) == (120, True)
    assert (got[23].n_symbols, got[23].n_dup_lines, got[23].word_chars) == (2, 1, 8)
    assert quality.quality(docs(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("few", [0, 48])
def test_repeat_words(spark, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW", few)
    g = random.Random(3)
    rows = [(i, " ".join(g.choice("abc") for _ in range(g.randint(0, 40))), "h") for i in range(60)]
    got = {r.doc_id: r.n_repeat_words for r in quality.quality(docs(spark, rows)).collect()}
    for i, t, _ in rows:
        ws, covered = t.split(), set()
        tri = [tuple(ws[j : j + 3]) for j in range(len(ws) - 2)]
        for j, x in enumerate(tri):
            covered |= {j, j + 1, j + 2} if tri.count(x) > 1 else set()
        assert got[i] == len(covered), t


def test_mixing(spark):
    g = random.Random(5)
    rows = [(i, "w " * g.randint(0, 50), g.choice(["a", "b", "b", "b", "c", "É", None])) for i in range(300)] + [(300, None, "z"), (5, "again", "a")]
    df = docs(spark, rows)
    got = mixing.mix(df).toPandas()
    by = got.groupby(got.source.fillna("~")).agg(size=("size", "sum"), taken=("taken", "sum"), target=("target", "first"))
    total, weights = int(by["size"].sum()), {}
    for k, s in enumerate(sorted(by.index, key=lambda s: (s == "~", s))):
        weights[s] = k % 3 + 1
    want, capped = {}, set()
    while True:
        level = (total - sum(3 * by["size"][s] for s in capped)) / sum(weights[s] for s in weights if s not in capped)
        over = {s for s in weights if s not in capped and level * weights[s] > 3 * by["size"][s]}
        if not over:
            break
        capped |= over
    for s in weights:
        want = 3 * by["size"][s] if s in capped else level * weights[s]
        assert abs(by["target"][s] - want) < 1e-6 and by["taken"][s] == int(by["target"][s] + 1e-9)
    assert (got.taken <= 3 * got["size"]).all()
    assert sorted(map(tuple, got[["doc_id", "taken"]].fillna(-1).values.tolist())) == sorted(map(tuple, mixing.mix(df.repartition(5)).toPandas()[["doc_id", "taken"]].fillna(-1).values.tolist()))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert mixed.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == got.taken.sum()
    assert mixing.mix(df.limit(0)).count() == 0


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)
    g = random.Random(6)
    rows = [(i, g.choice(["alpha ", "béta\n", "g  d "]) * g.randint(0, 90), "s") for i in range(80)] + [(80, None, "s"), (80, "twice", "s"), (None, "<|endoftext|> x", "s"), (81, "  \n x", "s")]
    out = packing.best_fit_pack(docs(spark, rows), path, capacity=64, with_ids=True).toPandas()
    pieces = {}
    for i, t, _ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        pieces.setdefault(-1 if i is None else i, []).append(ids)
    for i, group in out.fillna({"doc_id": -1}).groupby("doc_id"):
        if len(pieces[i]) == 1:
            group = group.sort_values("piece")
            assert [x for ids in group.ids for x in ids] == pieces[i][0] and list(group.start) == [0, *np.cumsum(group.length)[:-1]]
            assert (group.length[1:] == 64).all()
    assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(out.ids, out.ids_crc32))
    spans = out.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert spans.length.sum().max() <= 64 and all((g.offset == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all() for _, g in spans)
    assert packing.best_fit_pack(docs(spark, rows).limit(0), path).count() == 0


def test_packing_plan_uses_all_and_is_tight():
    g = np.random.default_rng(1)
    for _ in range(40):
        counts = np.bincount(g.integers(1, 65, g.integers(0, 300)), minlength=65)
        used = np.zeros(65, int)
        for lengths, times in packing.plan(counts, 64):
            assert sum(lengths) <= 64
            for n in lengths:
                used[n] += times
        assert (used == counts).all()


def test_language(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 40)]
    df = spark.createDataFrame([*rows, (900, "12 34 !", "en"), (901, None, "en"), (902, "²", None), (903, "thedogs", None), (904, "A" * 5000, "de"), (None, "und die", "de")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.language_id(df).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[903].lang_pred == "en" and got[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    assert {r.lang_pred for r in language.language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.language_id(df.limit(0)).count() == 0


def test_vectors(spark):
    g = np.random.default_rng(8)
    base = g.standard_normal((30, 16))
    near = [base[i % 5] + g.standard_normal(16) * s for i in range(60) for s in (0.05, 0.3)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate([*base, *near])]
    odd = [(500, None), (501, [0.0] * 16), (502, [1.0] * 15 + [None]), (503, [1.0] * 15 + [float("nan")]), (504, [float("inf")] * 16), (505, []), (506, rows[3][1]), (506, rows[3][1]), (None, rows[3][1]), (507, [1e300] * 16), (508, [1.0] * 8)]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>")
    out = vectors.near_duplicates(df, window=8, miss=1e-6).toPandas()
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1)[:, None]
    like = (m @ m.T >= 0.9) & ~np.eye(len(m), dtype=bool)
    got = out[out.vec_id < 500].set_index("vec_id")
    for i in range(len(rows)):
        assert got.n_links[i] == like[i].sum() + (3 if i == 3 or like[i][3] else 0), i
    assert (out[out.vec_id.isin([500, 501, 502, 503, 504, 505])].n_links == 0).all()
    assert out[out.vec_id.isin([500, 501, 505, 507, 508])].kept.all()
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_toxicity(spark):
    g = random.Random(9)
    word = lambda: "".join(g.choice("abcdefgh") for _ in range(4))
    rows, marks = [], []
    for i in range(260):
        ws = [word() for _ in range(g.randint(20, 150))]
        bad = i % 3 == 0
        if bad:
            for _ in range(4):
                ws[g.randrange(len(ws))] = g.choice(["zzvile", "zzvilest", "qqmean"])
        rows.append((i, " ".join(ws), "s"))
        marks.append((i, int(bad)))
    rows += [(900, None, "s"), (901, "", "s"), (None, "zzvile " * 90, "s")]
    labels = spark.createDataFrame([*marks, (None, 1), (7, None)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(docs(spark, rows), labels).collect()}
    held = [(out[i].predicted, t) for i, t in marks if out[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.85
    assert out[900].score == out[901].score == 0 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    assert {r.score for r in toxicity.toxicity(docs(spark, rows), labels.limit(0)).collect()} == {0.0}


def test_digest_of_queries_on_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.source) for r in queries.documents(spark, sf).collect()]
    want = brute_words(rows, 20)
    for r in queries.QUERIES["op3_substring_dedup"](spark, sf).collect():
        assert (r.n_words, r.n_removed, r.kept_sha256) == (*want[r.doc_id][:2], hashlib.sha256(want[r.doc_id][2].encode()).hexdigest())
    bytes_ = brute_bytes(rows, 400)
    for r in queries.QUERIES["op5_suffix_array_dedup"](spark, sf).collect():
        n, gone, spans, kept = bytes_[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("way", ["default", "more passes"])
def test_vectors_of_clustered_tables_in_many_partitions(spark, monkeypatch, way):
    """Planted pairs at cosine 0.905 in vectors of mean cosine 0.69, dealt into 64 partitions: none may be lost.

    They are so crowded that the default settings leave some to the exact way; where passes cost nothing they serve all.
    """
    g = np.random.default_rng(4)
    n, dim, planted = 4000, 64, 300
    x = g.standard_normal((n, dim)) * 0.67 / np.sqrt(dim)
    x[:, 0] += 1
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = g.standard_normal((planted, dim))
    side -= (side * x[:planted]).sum(axis=1)[:, None] * x[:planted]
    pairs = 0.905 * x[:planted] + np.sqrt(1 - 0.905**2) * side / np.linalg.norm(side, axis=1)[:, None]
    v = np.concatenate([x, pairs])
    like = (v @ v.T >= 0.9) & ~np.eye(len(v), dtype=bool)
    assert 0.6 < (v[:n] @ v[:n].T).mean() < 0.75 and like.sum() >= 2 * planted
    seen = []
    if way == "more passes":
        monkeypatch.setattr(vectors, "PASS_COST", 1)
    plan = vectors.passes_for
    monkeypatch.setattr(vectors, "passes_for", lambda bins, miss: seen.append(plan(bins, miss)) or seen[-1])
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "vec_id long, embedding array<double>")
        got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df, window=16).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    lost = [i for i in range(len(v)) if got[i] != like[i].sum()]
    assert not lost and seen[0][0] >= 1 and (way == "default" or seen[0][0] > 1)


def test_passes_find_planted_pairs_with_default_settings(spark, monkeypatch):
    """Pairs at 0.9 to 0.93 among vectors in all directions: passes alone find them, in many partitions, and nothing else."""
    g = np.random.default_rng(8)
    n, dim, planted = 3000, 64, 400
    x = g.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = g.standard_normal((planted, dim))
    side -= (side * x[:planted]).sum(axis=1)[:, None] * x[:planted]
    c = np.linspace(0.9005, 0.93, planted)[:, None]
    v = np.concatenate([x, c * x[:planted] + np.sqrt(1 - c**2) * side / np.linalg.norm(side, axis=1)[:, None]])
    like = (v @ v.T >= 0.9) & ~np.eye(len(v), dtype=bool)
    compared = []
    monkeypatch.setattr(vectors, "_against_all", lambda *_: compared.append(1))
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "vec_id long, embedding array<double>")
        got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    found = sum(got[i] == like[i].sum() for i in np.flatnonzero(like.any(axis=1)))
    assert not compared and found >= 0.99 * like.any(axis=1).sum() and not any(got[i] for i in np.flatnonzero(~like.any(axis=1)))


def test_plan_of_passes():
    assert vectors.passes_for({}, 1e-3) == (1, -1) and vectors.passes_for({vectors.LAST: 50}, 1e-3) == (1, -1)
    assert vectors.passes_for({3: 10}, 1e-3)[1] == 3 and vectors.passes_for({3: 10, 12: 5}, 1e-3)[1] == 12  # at any size
    assert vectors.passes_for({3: 10, 40: 5}, 1e-3)[1] == 3  # five vectors are compared with all instead of 7,000 passes
    assert vectors.passes_for({3: 10, 40: 10**9}, 1e-3)[1] == 40


def test_lines_of_short_texts_and_long_passages(spark):
    """Repeats on one or two lines: passages of over 50 words, and whole texts; short lines elsewhere stay."""
    one, half = " ".join(f"w{i}" for i in range(60)), [" ".join(f"{c}{i}" for i in range(26)) for c in "uv"]
    rows = [(1, f"intro\n{one}\nmore\nlast", "a"), (2, one.upper(), "a"), (3, f"other\n{one}", "a"), (4, "\n\n".join(half), "a"), (5, "x\n" + "\n".join(half) + "\ny", "a")]
    rows += [(6, "one\ntwo", "a"), (7, "One\n\n two", "a"), (8, "one", "a"), (9, "one\nthree", "a"), (10, half[0], "a"), (11, half[0] + "\nz", "a"), (12, "", "a"), (13, None, "a"), (14, "p\nq\nr\np\nq\nr", "a"), (None, "one", "a")]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(docs(spark, rows), long_words=50).collect()}
    assert got == {**{i: (t, 0) for i, t, _ in rows}, 2: ("", 1), 3: ("other", 1), 5: ("x\ny", 2), 7: ("", 3), 8: ("", 1), 14: ("p\nq\nr", 3)}


def test_frequent_lines_of_copies_are_counted_and_removed(spark):
    page = "Accept All 7 cookies\n" + " ".join(f"w{i}" for i in range(60))
    rows = [(i, page, "h") for i in range(6)] + [(9, "own words\naccept all 3  Cookies\nend", "h"), (10, page, "other"), (11, None, "h"), (5, page, "h")]
    body = page.split("\n")[1]
    df = docs(spark, rows)
    got = {r.doc_id: (r.text, r.n_frequent_words, r.kept) for r in quality.quality(df, limit=6).collect()}
    assert got == {**{i: (body, 4, True) for i in range(6)}, 9: ("own words\nend", 4, False), 10: (page, 0, True), 11: (None, 0, False)}
    texts = {r.doc_id: (r.text, r.n_frequent_words) for r in quality.quality(df, limit=7).collect()}
    assert texts == {i: (t, 0) for i, t, _ in rows}  # seven documents hold the line, two rows of one count once
    unnamed = docs(spark, [(None, f"{page}\nn{i}", "h") for i in "abc"])
    assert [r.n_frequent_words for r in quality.quality(unnamed, limit=2).collect()] == [4 + 60] * 3


def brute_lines(rows, run, long_words):
    """The rule of line dedup, word for word."""
    seen, out = {}, {}
    lines = lambda t: [(i, " ".join(WORD.findall(x.lower()))) for i, x in enumerate((t or "").split("\n")) if WORD.search(x)]
    spans = []
    for d, t, _ in rows:
        ls = lines(t)
        words = lambda part: sum(len(x.split()) for _, x in part)
        for k in range(1, run + 1):
            for j in range(len(ls) - k + 1):
                part = ls[j : j + k]
                if k == run or words(part) > long_words:
                    spans.append((d, part, (False, *(x for _, x in part))))
        if 0 < len(ls) < run and words(ls) <= long_words:
            spans.append((d, ls, (True, *(x for _, x in ls))))
    for d, part, key in sorted(spans, key=lambda x: (x[0], x[1][0][0])):
        if key in seen:
            out.setdefault(d, set()).update(range(part[0][0], part[-1][0] + 1))
        seen.setdefault(key, d)
    return {d: (t and "\n".join(x for i, x in enumerate(t.split("\n")) if i not in out.get(d, ())), len(out.get(d, ()))) for d, t, _ in rows}


@pytest.mark.parametrize("run", [2, 3, 5])
def test_lines_same_as_brute_force(spark, run):
    g = random.Random(run)
    pool = [" ".join(g.choice("abcdefghij") for _ in range(g.choice([1, 1, 2, 3, 7]))) for _ in range(12)]
    rows = [(i, "\n".join(g.choice([*pool, "", " \t", "A  b", f"own {i}"]) for _ in range(g.choice([0, 1, 2, 3, 8, 20]))), "s") for i in range(150)]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(docs(spark, rows).repartition(3), run=run, long_words=4).collect()}
    assert got == brute_lines(rows, run, 4)


def test_lines_of_a_very_long_text_and_clashing_columns(spark):
    body = "\n".join(f"line {i}" for i in range(60_000))
    df = docs(spark, [(1, body, "a"), (2, body + "\nmine", "a")]).withColumn("n_lines", F.lit(5)).withColumn("mark", F.lit("x"))
    got = {r.doc_id: r for r in lines.dedup_lines(df, long_words=50).collect()}
    assert got[1].text == body and (got[2].text, got[2].n_removed, got[2].n_lines, got[2].n_chars, got[2].mark) == ("mine", 60_000, 60_001, 4, "x")


def test_mix_numbers_repeats_and_orders_ties(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    rows = [(7, f"w{i} " * 5, "a") for i in range(40)] + [(None, f"n{i} " * 5, "a") for i in range(40)] + [(i, "x " * 100, "b") for i in range(20)]
    df = docs(spark, rows).withColumn("copy", F.lit("clash"))
    first = sorted((str(r.doc_id), r.text, r.copy) for r in mixing.mixed_documents(df, weights=(3, 1), number="copy").collect())
    assert first == sorted((str(r.doc_id), r.text, r.copy) for r in mixing.mixed_documents(df.repartition(7), weights=(3, 1), number="copy").collect())
    assert len(set(first)) == len(first) and {c for _, _, c in first} == {0, 1, 2}


def test_language_replaces_columns_of_its_own_names(spark):
    df = spark.createDataFrame([(1, "ja", "de", "old", 3), (2, "yes", "en", "old", 3)] * 2, "doc_id long, text string, lang string, lang_pred string, score int")
    model = language.train(df)
    out = language.identify(df, model, *df.columns)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and sorted(r.lang_pred for r in out.collect()) == ["de", "de", "en", "en"]


def test_language_same_as_plain_scorer(spark):
    """Every score of the smallest tables, from counts and backoff written out."""
    import math
    from collections import Counter

    df = queries.documents(spark, "/root/testdata/sf0.001")
    rows = [(r.doc_id, r.text, r.lang) for r in df.collect()]
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    counts, longest = {}, 5
    parts = lambda w, n: [x[i : i + n] for x in [f"\x02{w}\x03" if n > 1 else w] for i in range(len(x) - n + 1)]
    clean = lambda t: [w for w in ("".join(c for c in w if c.isalpha()) for w in re.findall(r"[^\W\d_]+", (t or "").lower())) if w]
    for d, t, lang in rows:
        if t is not None and lang is not None and not held(d):
            for w in clean(t):
                for n in range(longest + 1):
                    counts.setdefault(n, {}).setdefault(lang, Counter()).update([w] if n == 0 else parts(w, n))
    langs = sorted(counts[0])
    tables = {n: {lang: {g for g, k in sorted(c[lang].items(), key=lambda x: (-x[1], x[0]))[: 30_000 if n == 0 else 8_000] if k > 1} for lang in langs} for n, c in counts.items()}
    known = {n: set().union(*t.values()) for n, t in tables.items()}
    sums = {(n, x): sum(counts[n][x].values()) for n in counts for x in langs}
    logs = lambda n, g: [math.log(((counts[n][x][g] if g in tables[n][x] else 0) + 0.1) / (sums[n, x] + 0.1 * len(known[n]))) for x in langs]

    @functools.cache
    def word(w):
        if w in known[0]:
            return logs(0, w)
        for n in range(longest, 0, -1):
            if found := [logs(n, g) for g in parts(w, n) if g in known[n]]:
                return [sum(x) / len(found) for x in zip(*found)]
        return [0.0] * len(langs)

    for r in queries.QUERIES["op1_language_id"](spark, "/root/testdata/sf0.001").collect():
        ws = clean(next(t for d, t, _ in rows if d == r.doc_id))
        total = [sum(x) for x in zip(*map(word, ws))] if ws else None
        best = max(range(len(langs)), key=lambda i: total[i]) if ws else None
        assert r.lang_pred == (langs[best] if ws else "und")
        assert abs(r.score - (1 / sum(math.exp(max(-700, x - total[best])) for x in total) if ws else 0)) < 1e-3


def test_toxicity_gradients_and_plain_recurrence(spark):
    """Gradients against differences, and inference against one window, one step, one direction at a time."""
    net = toxicity.Network({"aa": 1, "bb": 2, "cc": 3}, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g = np.random.default_rng(0)
    tokens = ["aa", "bb", "cc", "dd!", "eeeeeeee"]
    lengths = np.array([7, 3, 1, 5])
    ids = g.integers(0, len(tokens), (4, 7))
    y, weight = np.array([1.0, 0, 1, 0]), np.array([2.0, 1, 2, 1])

    def loss():
        x, _ = net.inputs(tokens)
        p = 1 / (1 + np.exp(-net.forward(net.project(x), ids, lengths).astype(np.float64)))
        return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum())

    x, used = net.inputs(tokens)
    grads = net.gradients(x, used, net.project(x), ids, lengths, y, weight)
    for name in ("wx", "wh", "bx", "wa", "va", "wo", "bo", "word", "char"):
        flat, size = net.p[name].reshape(-1), np.abs(grads[name]).reshape(-1)
        for i in np.argsort(-size)[:3]:
            was = flat[i]
            ends = []
            for step in (1e-2, -1e-2):
                flat[i] = was + step
                ends.append(loss())
            flat[i] = was
            slope, want = (ends[0] - ends[1]) / 2e-2, grads[name].reshape(-1)[i]
            assert abs(slope - want) < 2e-3 + 0.03 * abs(want), (name, slope, want)

    net.p = {k: v.astype(np.float32) for k, v in net.p.items()}
    table = net.project(net.inputs(tokens)[0])
    sig = lambda v: 1 / (1 + np.exp(-v))
    H, order = toxicity.HIDDEN, np.argsort(-lengths)
    fast = net.infer(np.ascontiguousarray(table[:, 0]), np.ascontiguousarray(table[:, 1]), ids[order], lengths[order])
    for row, got in zip(order, fast):
        states = np.zeros((lengths[row], 2 * H))
        for d, steps in ((0, range(lengths[row])), (1, range(lengths[row] - 1, -1, -1))):
            h = np.zeros(H)
            for t in steps:
                a, b = table[ids[row, t], d].astype(float), h @ net.p["wh"][d]
                z, r = sig(a[:H] + b[:H]), sig(a[H : 2 * H] + b[H : 2 * H])
                h = (1 - z) * np.tanh(a[2 * H :] + r * b[2 * H :]) + z * h
                states[t, d * H : (d + 1) * H] = h
        e = np.exp(np.tanh(states @ net.p["wa"]) @ net.p["va"])
        assert abs((e / e.sum()) @ states @ net.p["wo"] + net.p["bo"][0] - got) < 1e-4


def test_packing_query_round_trip_at_full_size(spark, monkeypatch):
    """Every id of every document of the smallest tables, in place, in sequences of 2048."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "PART_ROWS", 2)
    sf = "/root/testdata/sf0.001"
    tok = Tokenizer.from_file(queries.tokenizer_path())
    texts = {r.doc_id: r.text for r in queries.documents(spark, sf).collect()}
    out = queries.QUERIES["op8_best_fit_packing"](spark, sf).toPandas()
    for i, group in out.groupby("doc_id"):
        ids, group = tok.encode(texts[i] or "", add_special_tokens=False).ids + [0], group.sort_values("piece")
        assert list(group.piece) == list(range(len(group))) and (group.length[1:] == 2048).all() and group.length.sum() == len(ids)
        for start, n, crc in zip(group.start, group.length, group.ids_crc32):
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
    assert set(out.doc_id) == set(texts)
    fill = out.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert fill.length.sum().max() <= 2048 and all((g.offset == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all() for _, g in fill)
    assert len(fill) <= -(-int(out.length.sum()) // 2048) + 1


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_same_as_sql(spark, name):
    from test_oracles import canonical, duck_tables

    got, want = queries.QUERIES[name](spark, "/root/testdata/sf0.001"), duck_tables().sql(queries.ORACLES[name])
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(want.columns, want.fetchall())


def test_ids_that_are_no_numbers_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(anchors, "ROWS_AT_ONCE", 5)
    monkeypatch.setattr(anchors, "SHARD", 100)
    rows = passages(4)
    df = docs(spark, rows)
    want = {i: (n, gone, spans, kept) for i, (n, gone, spans, kept) in brute_bytes(rows, 40).items()}
    cut = suffix.dedup_bytes(df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")).repartition(3), 40)
    assert {int(r.doc_id[1:]): (r.n_units, sum(s.stop - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in cut.collect()} == want
    first = {r.doc_id: (r.n_units, sum(s.stop - s.start for s in r.spans), r.kept) for r in substring.dedup_substrings(df.repartition(3), 20).collect()}
    assert first == brute_words(rows, 20)


def test_toxicity_training_rows_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: seen.append(texts) or toxicity.Model(None))
    rows = [(i, n and "x" * n, "s") for i, n in ((1, 10), (2, 500), (3, 10), (3, 7), (3, 7), (4, 10), (6, None))]
    labels = spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, toxic int")
    held = {r.doc_id for r in labels.filter(language.held_out()).collect()}
    toxicity.train(docs(spark, rows), labels, characters=40)
    assert sorted(map(len, seen[0])) == sorted(n for i, n in ((1, 10), (3, 7), (4, 10)) if i not in held)
