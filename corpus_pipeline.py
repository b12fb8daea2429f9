"""From `documents` to packed training sequences: language, lines, near copies, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with their columns; the last returns the
packed pieces. Between stages the rows are written as Parquet to the shared folder and read again, so a lost executor
costs a reread and no stage computes another one twice; what a stage has read is deleted when the next has been written.
The mix repeats documents; the packed pieces of each of its rows share a row_id, so that repeats can be told apart. The
pieces carry their token ids, so that what training reads depends on no other table.

Documents may have further columns, also such as operators return (lang_pred, score, n_lines, n_removed); they are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import common, language, lines, minhash, mixing, packing, queries

#: Texts below this share of the posterior for their best language are rejected.
LEAST_SCORE = 0.5


def _aside(docs: DataFrame, *taken: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with the columns renamed that an operator would take for its own, and the way back."""
    clash = {c: f"#own_{c}" for c in docs.columns if c in taken}
    return docs.withColumnsRenamed(clash), {v: k for k, v in clash.items()}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those in which no language has half of the posterior."""
    common.ship_package(spark)
    model = language.train(docs.filter(~language.held_out()))
    plain, back = _aside(docs, "lang_pred", "score")
    judged = language.identify(plain, model, *plain.columns)
    return judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*plain.columns).withColumnsRenamed(back)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later repeats of runs of three lines, of shorter runs of over 50 words, and of whole texts of one or two lines.

    A document that is all repeats goes.
    """
    plain, back = _aside(docs, "n_lines", "n_removed")
    cut = lines.dedup_lines(plain, run=3, long_words=50)
    return cut.filter((F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(*plain.columns).withColumnsRenamed(back)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity of 0.8 and more."""
    common.ship_package(spark)
    return minhash.dedup(docs, words=5, percent=80).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes whole epochs and a last partial one of each source, to weights 1, 2, 3 repeating."""
    return mixing.mixed_documents(docs, weights=(1, 2, 3), cap=3.0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs token sequences of 2048 and gives the ids of each piece; row_id tells rows of docs apart that share a doc_id.

    packing.sequences joins the pieces of a sequence. Ids without the last, which is the end id, decode to the mixed text.
    """
    common.ship_package(spark)
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_id"))
    return packing.best_fit_pack(numbered, queries.tokenizer_path(), capacity=2048, end_id=0, with_ids=True, carry=("row_id",))


STAGES = [
    ("language id", identify_language),
    ("line dedup", dedup_lines),
    ("minhash near-dedup", dedup_near_copies),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Language scores and token ids have no SQL form; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the packed pieces."""
    docs, held = queries.documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        kept = common.settle(stage(spark, docs, sf_dir))
        if held is not None:
            common.discard(held)
        docs = held = kept
    return STAGES[-1][1](spark, docs, sf_dir)
