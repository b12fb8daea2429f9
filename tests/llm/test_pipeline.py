"""Each stage of the pipeline on its own input, against plain Python."""

import datetime as dt
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import mixing, packing, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = queries.documents(spark, SF), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_columns_and_names(spark, stages):
    columns = queries.documents(spark, SF).columns
    assert [n for n, _, _ in stages] == ["language id", "line dedup", "minhash near-dedup", "source mixing", "best-fit packing"]
    assert all(after.columns == columns for _, _, after in stages[:-1])


def test_language_keeps_clean_documents(stages):
    _, before, after = stages[0]
    assert after.count() >= 0.99 * before.count() and after.exceptAll(before).count() == 0


def test_no_run_of_three_lines_starts_twice(stages):
    _, before, after = stages[1]
    runs = lambda df: [tuple(ls[i : i + 3]) for r in df.collect() for ls in [[" ".join(WORD.findall(x.lower())) for x in r.text.split("\n") if WORD.search(x)]] for i in range(len(ls) - 2)]
    kept = runs(after)
    first = set(runs(before))
    assert len(set(kept)) > 0.9 * len(first)
    assert len(kept) - len(set(kept)) <= 0.01 * len(kept)  # cuts may bring lines together anew


def test_no_two_kept_documents_are_alike(stages):
    sets = []
    for r in stages[2][2].collect():
        ws = WORD.findall(r.text.lower() if r.text.isascii() else r.text)
        sets.append({tuple(ws[j : j + 5]) for j in range(max(1, len(ws) - 4))} if ws else set())
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not (a and b and 100 * len(a & b) >= 80 * len(a | b))


def test_mix_meets_budgets(stages):
    _, before, after = stages[3]
    size = mixing.mix(before).groupBy("source").agg({"taken": "sum"})
    want = {r[0]: r[1] for r in size.collect() if r[1]}
    got = {}
    for r in after.collect():
        got[r.source] = got.get(r.source, 0) + len(WORD.findall(r.text))
    assert got == want


def test_packing_covers_the_mix(stages):
    _, before, after = stages[4]
    rows = after.collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048 and sum(1 for r in rows if r.piece == 0) == before.count()
    assert len(fill) <= 1.02 * -(-sum(fill.values()) // 2048) + 1


def test_ids_decode_to_the_mixed_texts(stages):
    """Piece by piece and sequence by sequence, with their checksums."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    _, before, after = stages[4]
    texts = {}
    for r in after.orderBy("row_id", "piece").collect():
        ids = np.array(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        texts.setdefault((r.doc_id, r.row_id), []).extend(r.ids)
    assert all(ids[-1] == 0 for ids in texts.values())
    got = Counter((i, tok.decode(ids[:-1], skip_special_tokens=False)) for (i, _), ids in texts.items())
    assert got == Counter((r.doc_id, r.text) for r in before.collect())
    whole = {}
    for r in packing.sequences(after, ("row_id",)).collect():
        assert len(r.ids) == sum(p.length for p in r.parts) <= 2048
        for p in r.parts:
            whole[p.row_id, p.piece] = r.ids[p.offset : p.offset + p.length]
    assert whole == {(r.row_id, r.piece): r.ids for r in after.collect()}


ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred int, n_lines string, n_removed int, component_id string, taken string, size string, ids string, row_id string, at timestamp"


def odd_documents(spark):
    """Nulls in every column, equal rows, an empty and a very long text, and columns that operators use themselves."""
    prose = "the quick brown fox jumps over the lazy dog and runs home\nwhile it rains again\n"
    long = "".join(f"{prose} number {i} of many lines\n" for i in range(100_000))  # 10 MB
    rest = ("clash", 1, "clash", 2, "clash", "clash", "clash", "clash", "clash", dt.datetime(2024, 1, 1))
    rows = [(i, f"{prose}story {i} " + " ".join(f"w{i}x{j}" for j in range(30)), "en", "s", 5, *rest) for i in range(30)]
    rows += [rows[0], (40, None, "en", None, None, *rest), (41, "", None, "s", 0, *rest), (None, "an unnumbered text of some words", None, None, None, *[None] * 10), (42, long, "en", "t", len(long), *rest)]
    return spark.createDataFrame(rows, ODD)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_documents_and_none(spark, stage):
    name, run = corpus_pipeline.STAGES[stage]
    docs = odd_documents(spark)
    out = run(spark, docs, SF)
    rows = {r[0]: r[1] for r in out.groupBy("doc_id").agg(F.count("*")).collect()}
    if stage < 4:
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert out.filter("doc_id = 3").select("score", "n_removed", "size", "row_id").first() == ("clash", 2, "clash", "clash")
        assert rows.get(42, 0) >= 1  # the long text stays
    else:
        assert set(rows) == {r.doc_id for r in docs.collect()} and rows[0] == 2 and rows[42] > 100 and rows[40] == rows[41] == rows[None] == 1
    empty = run(spark, docs.limit(0), SF)
    assert empty.columns == out.columns and empty.count() == 0, name
