"""Line dedup by winnowing over line hashes, with DataFrame functions only.

Each window of lines selects its least line hash as fingerprint, so that equal windows share one at equal places. Only
places whose fingerprint is selected at two or more places are joined, and only there a match is extended to both sides,
line by line, as far as a window that holds the fingerprint reaches; overlapping matches make up the longer runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import match, settle, without


def normal_line(line: Column) -> Column:
    """Lower case, white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), "[\\x20\\x09-\\x0D]+", " "))


def fingerprints(docs: DataFrame, run: int, long_words: int | None = None) -> DataFrame:
    """(doc_id, mark, place, print, around, before, whole): the lines that windows of `run` lines select, once each.

    `around` holds the lines within run - 1 of the fingerprint's, the (before + 1)-th of them, as (h, g, i, n): two
    hashes, the number of the line in the text, and its words. Blank lines are skipped. With long_words every line of
    more words selects itself, and so does the least line of two that together have more; a text of fewer than `run`
    lines selects its least line, and `whole` is true if it has no more than long_words words.
    """
    normal = F.transform(F.split("text", "\n"), normal_line)
    hashed = F.transform(normal, lambda x, i: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"), i.alias("i"), F.when(x == "", 0).otherwise(F.size(F.split(x, " "))).alias("n")))
    full = F.filter(hashed, lambda x: x["n"] > 0)
    # explode() of one element: the array is computed once, not once for each use below.
    lines = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.explode(F.array(full)).alias("ls"))
    windows = lambda k: f"if(size(ls) < {k}, cast(array() as array<int>), sequence(0, size(ls) - {k}))"  # noqa: E731  the first places
    least = lambda k: f"array_min(transform(slice(ls, s + 1, {k}), (x, j) -> struct(x.h as h, s + j as p))).p"
    if long_words is None:
        usable, selected, short = F.size("ls") >= run, f"transform({windows(run)}, s -> {least(run)})", F.lit(False)
    else:
        usable, of = F.size("ls") > 0, lambda k: f"aggregate(slice(ls, s + 1, {k}), 0, (a, x) -> a + x.n)"
        longer = [f"transform(filter({windows(k)}, s -> {of(k)} > {long_words}), s -> {least(k)})" for k in range(1, run)]
        all_of = f"if(size(ls) < {run}, array({least('size(ls)').replace('s + 1', '1').replace('s + j', 'j')}), cast(array() as array<int>))"
        selected = f"concat(transform({windows(run)}, s -> {least(run)}), {all_of}, {', '.join(longer)})"
        short = (F.size("ls") < run) & (F.expr("aggregate(ls, 0, (a, x) -> a + x.n)") <= long_words)
    chosen = lines.filter(usable).select("doc_id", "mark", "ls", short.alias("whole"), F.explode(F.array_distinct(F.expr(selected))).alias("place"))
    first = f"greatest(0, place - {run - 1})"
    around = F.expr(f"slice(ls, {first} + 1, place - {first} + {run})")
    return chosen.select("doc_id", "mark", "place", F.expr("ls[place].h").alias("print"), around.alias("around"), F.expr(f"place - {first}").alias("before"), "whole")


def extended(joined: DataFrame, run: int, long_words: int | None = None) -> DataFrame:
    """(doc_id, mark, first, last, one, two): each window of the joined fingerprints, with two hashes of its content.

    first and last are line numbers. Windows are those of `run` lines and, with long_words, shorter ones of more words;
    a whole short text of no more words meets only other such texts.
    """
    # A window of k lines begins up to k - 1 lines before its fingerprint, and ends within what is around that.
    least = "array_min(transform(slice(around, s + 1, {k}), (x, j) -> struct(x.h as h, s + j as p))).p"
    begins = lambda k: f"filter(sequence(greatest(0, before - {k - 1}), before), s -> s + {k} <= size(around) and {least.format(k=k)} = before)"
    spans = [f"transform({begins(run)}, s -> slice(around, s + 1, {run}))"]
    if long_words is not None:
        spans += [f"filter(transform({begins(k)}, s -> slice(around, s + 1, {k})), w -> aggregate(w, 0, (a, x) -> a + x.n) > {long_words})" for k in range(1, run)]
        spans.append("if(whole, array(around), slice(array(around), 1, 0))")
    each = joined.select("doc_id", "mark", "whole", F.explode(F.expr(f"concat({', '.join(spans)})")).alias("w"))
    alone = F.col("whole") & (F.size("w") < run)
    one, two = (F.xxhash64(alone, F.transform("w", lambda x: x[c])) for c in "hg")
    return each.select("doc_id", "mark", F.col("w")[0]["i"].alias("first"), F.element_at("w", -1)["i"].alias("last"), one.alias("one"), two.alias("two"))


def dedup_lines(docs: DataFrame, run: int = 3, long_words: int | None = None) -> DataFrame:
    """Delete later repeats of runs of at least `run` lines; returns the columns of docs with text cut, and n_lines, n_removed.

    A line goes if it lies in `run` consecutive lines (blank ones skipped) whose sequence, in lower case and with white
    space evened out, also starts earlier: in a smaller doc_id, or earlier in the same document. Windows are judged on
    the input. Winnowing keeps one fingerprint for each window; places whose fingerprint is selected at two or more
    places are joined and extended, and equal extensions are repeats of the earliest. Blank lines inside a deleted run
    go with it. With long_words, shorter runs that hold more than so many words go too where they start again, and texts
    of fewer than `run` lines that are, as a whole, such an earlier text. Rows that share doc_id and text are one
    document; rows that share the doc_id only are told apart. A null text stays null; a null doc_id comes before all
    others. n_chars follows the text; columns named n_lines or n_removed are replaced. An empty table gives no rows.
    """
    prints = settle(fingerprints(docs, run, long_words))
    places = prints.select("print", "doc_id", "mark", "place").distinct().groupBy("print").count().filter("count > 1")
    windows = settle(extended(prints.join(places, "print", "left_semi"), run, long_words))
    place = F.struct("doc_id", "mark", "first")
    # Written out, so that the join below reads it as it stands and a window that very many texts hold can be split.
    firsts = settle(windows.groupBy("one", "two").agg(F.min(place).alias("origin"), F.max(place).alias("end")).filter("not origin <=> end").drop("end"))
    later = windows.join(firsts, ["one", "two"]).filter(~place.eqNullSafe(F.col("origin")))
    runs = later.groupBy("doc_id", "mark").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", "last"))))).alias("#gone")).withColumnRenamed("mark", "#mark")
    joined = match(docs.drop("n_lines", "n_removed").withColumn("#mark", F.xxhash64("text")), runs, ["doc_id", "#mark"], "left").withColumn("#lines", F.explode(F.array(F.split("text", "\n"))))
    text = F.when(F.col("#gone").isNull(), F.col("text")).otherwise(F.array_join(without(F.col("#lines"), F.col("#gone")), "\n"))
    columns = [text.alias("text") if c == "text" else F.length(text).cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes if c not in ("n_lines", "n_removed")]
    return joined.select(*columns, F.coalesce(F.size("#lines"), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("#gone"), F.lit(0)).cast("long").alias("n_removed"))
