"""Near copies against brute force, on texts made to need every path."""

import random
import re

import numpy as np
import pytest

from quillon.llm import minhash


def brute(rows, words, percent=80):
    sets = {}
    for i, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(ws[j : j + words]) for j in range(max(1, len(ws) - words + 1))} if ws else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if y < x and sets[x] and sets[y]:
                k = len(sets[x] & sets[y])
                if 100 * k >= percent * (len(sets[x]) + len(sets[y]) - k):
                    a, b = find(x), find(y)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus():
    g = random.Random(4)
    word = lambda: "".join(g.choice("abcdefgh") for _ in range(4))
    rows, base = [], [word() for _ in range(60)]
    for _ in range(40):  # drifts away step by step: ends are not alike, neighbours are
        base = [word() if g.random() < 0.02 else w for w in base]
        rows.append(" ".join(base))
    for _ in range(30):
        rows.append(" ".join(word() if g.random() < 0.05 else w for w in base))
    rows += [" ".join(word() for _ in range(g.choice([1, 2, 30]))) for _ in range(40)] + ["", None, " \t\n", "one", "One", "two words", rows[3], rows[3].upper()]
    g.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words", [2, 5])
def test_same_as_brute_force(spark, words):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, label int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, words=words).collect()}
    assert got == brute(rows, words)


def test_repeated_and_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (2, "x")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, 1, False), (2, 2, True), (2, 2, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    assert minhash.dedup(df).count() == 2


def test_overlaps():
    g = np.random.default_rng(2)
    sets = [np.unique(g.integers(0, 50, n)) for n in (5, 20, 40, 1)]
    got = minhash.overlaps(sets, sets, columns=7)
    assert got.tolist() == [[float(len(np.intersect1d(a, b))) for b in sets] for a in sets]


def test_dedup_keeps_different_texts_of_one_id_and_of_none(spark):
    long = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(None, long("a")), (None, long("b")), (None, long("b")), (1, long("c")), (1, long("d")), (1, long("d")), (3, long("d") + " x"), (0, long("e")), (1, long("e") + " y"), (2, None), (2, ""), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in minhash.dedup(df).collect()), key=repr)
    assert got == sorted([(None, long("a")), (None, long("b")), (1, long("c")), (1, long("d")), (0, long("e")), (2, None), (2, ""), (None, None), (None, "")], key=repr)
