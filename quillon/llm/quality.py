"""Quality rules over the line frequencies of hosts, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import WORD_SPLIT, match, settle, without

_SPACES = "\t\n\x0b\x0c\r"
#: Up to so many distinct repeated windows a text is searched by list, beyond that by sorting.
FEW = 48


def normal_line(line: Column) -> Column:
    """Lower case, digits as 0, white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.translate(F.lower(line), "123456789", "000000000"), WORD_SPLIT, " "))


def base_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text, beside the columns to keep."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.trim(F.translate(text, _SPACES, "     "))
    words = F.when(F.length(bare) > 0, F.split(bare, " +")).otherwise(F.array().cast("array<string>"))
    full = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, _SPACES, "     ")) != "")
    # Each explode() of one element keeps an array that is used more than once from being computed more than once.
    first = docs.select(
        *keep,
        F.length(F.translate(text, " " + _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(full), lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))[0].cast("long").alias("n_dup_lines"),
        F.explode(F.array(words)).alias("ws"),
    )
    hashes = F.expr("if(size(ws) < 3, cast(array() as array<bigint>), slice(transform(ws, (w, i) -> xxhash64(w, get(ws, i + 1), get(ws, i + 2))), 1, size(ws) - 2))")
    second = first.select(*keep, "word_chars", "n_symbols", "n_dup_lines", F.size("ws").cast("long").alias("n_words"), F.explode(F.array(hashes)).alias("hs"))
    third = second.withColumn("sorted", F.explode(F.array(F.sort_array("hs"))))
    fourth = third.withColumn("twice", F.explode(F.array(F.expr("array_distinct(filter(sorted, (h, i) -> h = get(sorted, i - 1)))")))).drop("sorted")
    by_list = "filter(transform(hs, (h, i) -> if(array_contains(twice, h), i, -1)), i -> i >= 0)"
    by_sort = (
        "transform(array(array_sort(transform(hs, (h, i) -> struct(h as h, i as i)))), "
        "s -> array_sort(transform(filter(transform(s, (x, j) -> struct(x.i as i, x.h = get(s, j - 1).h or x.h = get(s, j + 1).h as again)), x -> x.again), x -> x.i)))[0]"
    )
    at = F.expr(f"case when size(twice) = 0 then cast(array() as array<int>) when size(twice) <= {FEW} then {by_list} else {by_sort} end")
    fifth = fourth.withColumn("at", F.explode(F.array(at))).drop("hs", "twice")
    covered = F.expr("aggregate(at, struct(0L as n, -3 as last), (a, p) -> struct(a.n + least(3, p - a.last) as n, p as last), a -> a.n)")
    return fifth.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"))


def frequent_lines(docs: DataFrame, host: str, limit: int) -> DataFrame:
    """Of each row (doc_id, mark, host): how many words stand in lines that more than `limit` documents of the host hold, and the numbers of those lines (at)."""
    line = F.posexplode(F.split("text", "\n")).alias("at", "line")
    lines = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.col(host).alias("host"), line)
    normal = lines.select("doc_id", "mark", "host", "at", normal_line(F.col("line")).alias("line")).filter("line <> ''")
    # Two hashes, as a line is removed by them alone.
    spaces = F.length("line") - F.length(F.translate("line", " ", ""))
    hashed = normal.select("doc_id", "mark", "host", "at", F.xxhash64("line").alias("hash"), F.xxhash64(F.lit(1), "line").alias("hash2"), (spaces + 1).cast("long").alias("words"))
    hashed = settle(hashed)  # read twice, and much less than the texts
    # Rows that repeat a document count once; documents without a doc_id are told apart by their text.
    unnamed = F.when(F.col("doc_id").isNull(), F.col("mark"))
    by_document = hashed.groupBy("host", "hash", "hash2", "doc_id", unnamed).agg(F.count("*").alias("n"))
    often = by_document.groupBy("host", "hash", "hash2").agg(F.count("*").alias("documents")).filter(F.col("documents") > limit).drop("documents")
    found = match(hashed, often, ["hash", "hash2", "host"])
    return found.groupBy("doc_id", "mark", "host").agg(F.sum("words").alias("frequent"), F.sort_array(F.collect_set("at")).alias("at"))


def quality(docs: DataFrame, host: str = "source", limit: int = 50, depleted: float = 0.5, min_words: int = 50, max_repeat: float = 0.5) -> DataFrame:
    """Rules for each document (doc_id, text and the host column).

    Lines are normalised and hashed, the distinct documents (doc_ids) that hold a line are counted for each host, copies
    included, and lines held by more than `limit` of a host's documents are removed. A document is rejected if more than
    `depleted` of its words stood in such lines, or if it fails the base rules: fewer than min_words words, or more than
    max_repeat of its words in 3-word windows found twice or more. Returns doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_frequent_words, base_failed, kept, and the text without the lines removed. A null
    text has no words; null hosts are one host; documents without a doc_id are told apart by their text. Rows that
    repeat doc_id, host and text are judged alike (their repeats count once for the limit). An empty table gives no rows.
    """
    slim = docs.select("doc_id", "text", F.col(host).alias("host")).withColumn("mark", F.xxhash64("text"))
    base = base_counts(slim, "doc_id", "host", "mark", "text")
    frequent = frequent_lines(docs, host, limit)
    # A row of `frequent` sums over the rows that repeat it; their number is in n_same.
    same = slim.groupBy("doc_id", "host", "mark").agg(F.count("*").alias("n_same")).filter("n_same > 1")
    rows = ["doc_id", "mark", "host"]
    share = match(frequent, same, rows, "left").select(*rows, F.expr("frequent div coalesce(n_same, 1)").alias("n_frequent"), "at")
    joined = match(base, share, rows, "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > F.lit(int(100 * max_repeat)) * F.col("n_words"))
    emptied = F.coalesce(F.col("n_frequent"), F.lit(0)) > depleted * F.col("n_words")
    # A function over an array of one text cuts it into lines once, and only where the text is asked for.
    rest = F.transform(F.array(F.split("text", "\n")), lambda lines: without(lines, F.col("at")))[0]
    text = F.when(F.col("at").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.coalesce("n_frequent", F.lit(0)).cast("long").alias("n_frequent_words"), failed.alias("base_failed"), (~failed & ~emptied).alias("kept"), text.alias("text"))
