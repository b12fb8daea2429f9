"""Vector codes, byte-level BPE and cascading release against plain Python, and on edge cases."""

import base64
import hashlib
import math
import random
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

from quillon.llm import bpe, cascade, codes, queries

PATH, PATTERN = queries.ranks()


# Vector codes


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, lab, [math.floor(Fraction(x) * scale) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = -(-max((len(v) for _, _, v in kept), default=0) // parts) * parts
    kept = [(i, lab, v + [0] * (dim - len(v))) for i, lab, v in kept]
    w = dim // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, _, v in kept:
                groups.setdefault(near(v, p)[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, lab, "".join(f"{near(v, p)[1]:02x}" for p in range(parts)), sum(near(v, p)[0] for p in range(parts))) for i, lab, v in kept]
    total = {}
    for _, lab, _, e in out:
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, c, min(e, codes.MOST), min(total[lab], codes.MOST), digest) for i, lab, c, e in out), key=repr)


VECTORS = "vec_id long, embedding array<double>, label int, code string, n int, error double"


def coded(spark, rows):
    got = codes.compress(spark.createDataFrame([(i, v, lab, "clash", 1, 0.5) for i, v, lab in rows], VECTORS).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def vectors(seed, n, dim, size=0.3):
    g = random.Random(seed)
    return [(g.choice([i, i, 3]), [g.gauss(0, size) for _ in range(dim)], g.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("size", [0.3, 3e3, 1e7])  # 16, 32 bits, and what 64 bits do not hold
def test_codes_equal_brute_force(spark, size):
    rows = vectors(4, 90, 16, size)
    rows += [(500, None, 1), (501, [0.1] * 15 + [None], 1), (502, [float("nan")] * 16, 1), (503, [float("inf")] + [0.0] * 15, 2), (None, [0.1] * 16, 2), (504, [], None), (505, [0.2] * 5, 1)]
    rows += [rows[0], rows[0]]
    assert coded(spark, rows) == brute_codes(rows)


def test_codes_of_few_and_odd_tables(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1)]) == []
    for rows in ([(1, [0.5] * 8, None)], [(1, [], 1), (2, [], None)], [(i, [0.25] * 8, 1) for i in range(40)], vectors(2, 20, 11)):
        assert coded(spark, rows) == brute_codes(rows)


# Byte-level BPE


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(PATH).read_bytes().splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def odd_texts():
    g = random.Random(3)
    letters = "abcdefghij éüñ 中文 \n\t  0123 '’!?… ́‍🙂\x00\x1c\x85"
    out = ["", None, " ", "  x", "x  ", "<|endoftext|>", "don't WON'T", "a" * 5000, " " * 3000 + "b", "ab" * 4000, "\n" * 999]
    return out + ["".join(g.choice(letters) for _ in range(g.randint(1, 300))) for _ in range(150)]


@pytest.mark.parametrize("at_once", [7, 500_000])
def test_encoder_equals_the_library(reference, monkeypatch, at_once):
    monkeypatch.setattr(bpe, "AT_ONCE", at_once)
    coder, texts = bpe.Encoder(bpe.vocabulary(PATH, PATTERN)), odd_texts()
    ids, bounds = coder(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == reference.encode_ordinary(text or "")


def test_every_kind_of_character(reference):
    coder = bpe.Encoder(bpe.vocabulary(PATH, PATTERN))
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}." for c in points[i : i + 40]) for i in range(0, len(points), 40)]
    ids, bounds = coder(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [reference.encode_ordinary(t) for t in texts]


def test_perfect_hash_has_a_slot_for_each_key_and_finds_nothing_else():
    g = random.Random(1)
    keys = list({g.randbytes(g.randint(1, 9)) for _ in range(3000)})
    table = bpe.PerfectHash(keys)
    assert sorted(table.slot_key.tolist()) == list(range(len(keys)))
    strange = [k + b"x" for k in keys] + [b"", b"zz" * 40]
    strange = [s for s in strange if s not in set(keys)]
    for asked, want in ((keys, list(range(len(keys)))), (strange, [-1] * len(strange))):
        edges = np.cumsum([0, *map(len, asked)])
        assert table.find(np.frombuffer(b"".join(asked), np.uint8), edges[:-1], edges[1:]).tolist() == want
    assert bpe.PerfectHash([]).find(np.zeros(1, np.uint8), np.array([0]), np.array([1])).tolist() == [-1]


def test_bpe_on_a_table(spark, reference):
    texts = odd_texts() + ["x " * 400_000, "q" * 100_000]
    rows = [(i % 150, t, "clash", 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int").repartition(3)
    got = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN)
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = sorted((i, np.array(reference.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, _, _ in rows)
    assert sorted((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got.collect()) == want
    assert bpe.decode(bpe.encode(docs.limit(0), PATH, PATTERN), PATH, PATTERN).count() == 0
    null = bpe.decode(spark.createDataFrame([(None,)], "ids binary"), PATH, PATTERN).collect()
    assert null[0].decoded is None
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([(b"\xff\xff\xff\x7f",)], "ids binary"), PATH, PATTERN).collect()


def test_op12_on_the_documents(spark, reference):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.QUERIES["op12_byte_bpe"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = reference.encode_ordinary(r.text or "")
        own = got.pop(r.doc_id)
        assert own.n_tokens == len(ids) and own.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert not got


# Cascading release


def brute_replay(rows):
    text = lambda v: "" if v is None else str(v)
    out, convs = [], {}
    for c, t, x in rows:
        convs.setdefault(c, []).append((t is None, t or 0, zlib.crc32((x or "").encode()), t))
    for c, turns in convs.items():
        turns.sort(key=lambda r: r[:3])
        until, mine = [], []
        for p, (_, _, weight, t) in enumerate(turns):
            h = lambda k: zlib.crc32(f"{k}:{text(c)}:{text(t)}".encode())
            back, faulty, repaired = h(0) % 5, h(1) % 101 < 50, 7 * p + h(2) % 101
            at = max(7 * p, until[p - back] if 0 < back <= p else 0)
            if at == math.inf:
                until.append(at)
                mine.append([c, t, "blocked", 0, None, None, None, None])
                continue
            first, attempt = at, 1
            while faulty and (at < repaired or h(attempt + 2) % 3 == 0) and attempt < 6:
                at, attempt = at + 20 * 2 ** (attempt - 1), attempt + 1
            dead = faulty and (at < repaired or h(attempt + 2) % 3 == 0)
            until.append(math.inf if dead else at)
            mine.append([c, t, "dead" if dead else "delivered", attempt, first, at, None, None])
        state = 0
        done = sorted((r[5], turns[p][:2], p) for p, r in enumerate(mine) if r[2] == "delivered")
        for n, (_, _, p) in enumerate(done, 1):
            state += n * turns[p][2]
            mine[p][6:] = [n, (state + 2**63) % 2**64 - 2**63]
        out += map(tuple, mine)
    return sorted(out, key=repr)


def replayed(spark, rows, kind="long", parts=3):
    turns = spark.createDataFrame([(c, t, x, "user", 3, "clash") for c, t, x in rows], f"conv_id {kind}, turn long, text string, role string, part int, state string")
    got = cascade.replay(turns.repartition(parts))
    assert got.columns == ["conv_id", "turn", "status", "attempts", "first_at", "last_at", "release_no", "state"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_replay_equals_brute_force(spark):
    g = random.Random(5)
    rows = [(c, t, g.choice([None, "", f"text {t}", "é" * 5])) for c in range(30) for t in range(g.randint(1, 25))]
    rows += [(77, t, f"long {t}") for t in range(900)]  # cut by every part, with chains across the cuts
    rows += [(None, t, "x") for t in (1, 2, None)] + [(5, None, "n")] * 3 + [(6, 2, "same")] * 40 + [(6, 2, "other")]
    assert replayed(spark, rows) == brute_replay(rows)


@pytest.mark.parametrize("n", [0, 1, 7, 23])
def test_replay_where_parts_are_shorter_than_a_chain(spark, n):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [("one", t, str(t)) for t in range(n)]
        assert replayed(spark, rows, "string", parts=5) == brute_replay(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_part_holds_a_conversation_or_equal_rows(spark):
    rows = [(1, 5, "same")] * 3000 + [(2, t, "x") for t in range(10)]
    held = cascade._ordered(spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(5), *(c for c in ["conv_id", "turn"]))
    sizes = [r["count"] for r in held.groupBy("part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
    assert replayed(spark, rows) == brute_replay(rows)
