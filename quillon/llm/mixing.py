"""Mixing sources to target weights: hash-random order within each source, distributed prefix sums, an exact cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import WORD_SPLIT, settle

#: A range of the random key holds about so many rows at most; its hexadecimal digits follow from the number of rows.
RANGE_ROWS = 2_000


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    bare = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, " +"))).otherwise(0).cast("long")


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    """A hash of the doc_id, or of the text where there is none."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), text), F.lit(""))))


def range_digits(rows: int) -> int:
    """Digits of the key that name a range, so that a source of all rows has about RANGE_ROWS in each."""
    digits = 1
    while 16**digits * RANGE_ROWS < rows and digits < 8:
        digits += 1
    return digits


def source_targets(sums: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """(source_key, source_size, target): weights repeat in the order of the sources; no target is above cap * size.

    The level that the uncapped sources share is found in one pass over the sources in the order of cap * size /
    weight: a source is capped exactly if the level that would hold from it on lies above its own ratio.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(Window.orderBy("source_key")) - 1) % len(weights) + 1).cast("int"))
    sources = sums.groupBy("source_key").agg(F.sum("size").alias("source_size")).withColumn("weight", w)
    ordered = sources.withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    ahead = Window.orderBy("ratio", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "source_key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("ratio", "source_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(ahead), F.lit(0))) / F.sum("weight").over(rest)
    capped = ordered.withColumn("level", level).withColumn("capped", F.col("level") > F.col("ratio"))
    # The first source that is not capped has the level of all that follow.
    shared = F.min(F.when(~F.col("capped"), F.struct("ratio", "source_key", "level"))).over(everything)["level"]
    target = F.when(F.col("capped"), cap * F.col("source_size")).otherwise(shared * F.col("weight"))
    return capped.select("source_key", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """How many words of each document (doc_id, text, source) the mix takes, repeats counted.

    Each source's documents are ordered by a random key, a hash of the doc_id. Its target, cut to whole words, is met
    exactly: full epochs over the source, then documents in that order until the budget is reached, of the last one
    only the words still missing. The key is cut into ranges; sums over (source, range) give every document its prefix
    sum from a small table, so no source is ordered by one task. Returns doc_id, source, size, source_size, target,
    taken and the columns of `carry`. A null text has size 0 and a null source is a source of its own, the last. Rows
    that repeat a doc_id are documents of their own, next to each other in the order of their sizes and texts; rows
    without one are ordered by their texts. An empty table gives no rows.
    """
    columns = list(dict.fromkeys(("doc_id", "source", *carry)))
    sized = docs.select(*columns, word_count(F.col("text")).alias("#size"), random_key(F.col("doc_id"), F.col("text"), seed).alias("#key"), F.xxhash64("text").alias("#mark"))
    digits = range_digits(docs.count())
    sized = sized.withColumn("#source", F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))).withColumn("#range", F.substring("#key", 1, digits))
    sums = settle(sized.groupBy(F.col("#source").alias("source_key"), F.col("#range").alias("range")).agg(F.sum("#size").alias("size")))
    ahead = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_key", "range", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("#ahead"))
    table = offsets.join(source_targets(sums, weights, cap), "source_key").select(F.col("source_key").alias("#source"), F.col("range").alias("#range"), "#ahead", F.col("source_size").alias("#source_size"), F.col("target").alias("#target"))
    within = Window.partitionBy("#source", "#range").orderBy("#key", "#size", "#mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sized.withColumn("#within", F.sum("#size").over(within) - F.col("#size")).join(table, ["#source", "#range"])
    budget = F.floor("#target").cast("long")
    epochs = F.when(F.col("#source_size") > 0, F.floor(budget / F.col("#source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("#source_size") - F.col("#ahead") - F.col("#within")
    taken = epochs * F.col("#size") + F.greatest(F.lit(0), F.least(F.col("#size"), left))
    return placed.select(*columns, F.col("#size").alias("size"), F.col("#source_size").alias("source_size"), F.col("#target").alias("target"), taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: str = "mix", number: str | None = None) -> DataFrame:
    """The mix itself: the columns of docs, each document as often as it is taken; the last of a budget cut to its words.

    Documents without words weigh nothing and are not in the mix. The cut document has its words joined by one space.
    With `number` a column of that name counts the repeats of a document from 0.
    """
    own = [F.col(c).alias(f"@{c}") for c in docs.columns]
    mixed = mix(docs.select("doc_id", "source", "text", *own), weights, cap, seed, ("text", *(f"@{c}" for c in docs.columns))).filter("taken > 0")
    whole, part = F.expr("int(taken div size)"), F.expr("int(taken % size)")
    times = F.expr("sequence(0, int(ceil(taken / size)) - 1)")
    words = F.filter(F.split("@text", WORD_SPLIT), lambda w: w != "")
    cut = F.array_join(F.slice(words, 1, part), " ")
    repeated = mixed.withColumn("#copy", F.explode(times))
    text = F.when(F.col("#copy") >= whole, cut).otherwise(F.col("@text"))
    kinds = dict(docs.dtypes)
    columns = [text.alias(c) if c == "text" else F.length(text).cast(kinds[c]).alias(c) if c == "n_chars" else F.col(f"@{c}").alias(c) for c in docs.columns if c != number]
    return repeated.select(*columns, *([F.col("#copy").cast("int").alias(number)] if number else []))
