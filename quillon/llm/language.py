"""Language identification by word-first backoff.

A word seen in training is scored by its log frequency in each language. A word never seen falls back to its longest
character n-grams that were seen, then to shorter ones, down to single characters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillon.llm.common import settle, slices, tidy

#: Runs of letters, with the few number signs that regular expressions count as letters; those are dropped later.
_RUN = re.compile(r"[^\W\d_]+")
CACHE = 100_000


def words(text: str) -> list[str]:
    """Words of a text in lower case: runs of letters."""
    return _RUN.findall(text.lower())


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def grams(word: str, longest: int) -> Iterator[tuple[int, list[str]]]:
    """(n, n-grams of the word with its ends marked), longest first."""
    marked = f"\x02{word}\x03"
    for n in range(longest, 0, -1):
        source = marked if n > 1 else word
        if len(source) >= n:
            yield n, [source[i : i + n] for i in range(len(source) - n + 1)]


class Model:
    """Log frequencies per language: of each length (0: whole words) the rows of known grams and a matrix of scores."""

    def __init__(self, langs: list[str], rows: list[dict[str, int]], scores: list[np.ndarray], longest: int):
        self.langs, self.rows, self.scores, self.longest = langs, rows, scores, longest

    def score(self, word: str) -> np.ndarray:
        """Log probability of a word in each language, up to a constant; zeros if nothing of it was ever seen."""
        word = letters(word)
        if not word:
            return np.zeros(len(self.langs))
        if (known := self.rows[0].get(word)) is not None:
            return self.scores[0][known]
        for n, parts in grams(word, self.longest):
            if hits := [x for x in map(self.rows[n].get, parts) if x is not None]:
                return self.scores[n][hits].mean(axis=0)
        return np.zeros(len(self.langs))


class _Rows(dict):
    """Row of each word in a growing matrix of scores; emptied when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.matrix = model, np.zeros((1024, max(1, len(model.langs))))

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row >= len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[row] = self.model.score(word)
        self[word] = row
        return row


def train(docs: DataFrame, sample: int = 20_000, vocabulary: int = 30_000, parts: int = 8_000, longest: int = 5) -> Model:
    """Learn from rows with a text and a lang, on at most about `sample` of them, chosen by a hash of the text.

    The bound is documented: the model's tables hold at most `vocabulary` words and `parts` n-grams of each length for
    each language, so beyond some thousand texts a language more rows change little. Counting is distributed; only the
    bounded tables reach the driver.
    """
    usable = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    total = usable.count()
    if total > sample:
        usable = usable.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < int(1_000_003 * sample / total))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(words(text))
        rows = []
        for lang, counts in found.items():
            tally: Counter = Counter()
            for word, n in counts.items():
                if word := letters(word):
                    tally[0, word] += n
                    for k, gs in grams(word, longest):
                        for g in gs:
                            tally[k, g] += n
            rows += [(lang, k, g, n) for (k, g), n in tally.items()]
        cols = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())], ["lang", "k", "gram", "n"])

    counted = settle(usable.mapInArrow(count, "lang string, k int, gram string, n long").groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")))
    sums = {(r["lang"], r["k"]): r["n"] for r in counted.groupBy("lang", "k").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({lang for lang, _ in sums})
    rows: list[dict[str, int]] = [{} for _ in range(longest + 1)]
    scores = [np.zeros((0, len(langs)), np.float32)] * (longest + 1)
    if langs:
        from pyspark.sql import Window

        cells: list[list[tuple[int, int, int]]] = [[] for _ in rows]
        most = F.when(F.col("k") == 0, vocabulary).otherwise(parts)
        top = counted.filter("n > 1").withColumn("nth", F.row_number().over(Window.partitionBy("lang", "k").orderBy(F.desc("n"), "gram"))).filter(F.col("nth") <= most)
        of_lang = {lang: i for i, lang in enumerate(langs)}
        for r in top.select("lang", "k", "gram", "n").toLocalIterator():
            cells[r["k"]].append((rows[r["k"]].setdefault(r["gram"], len(rows[r["k"]])), of_lang[r["lang"]], r["n"]))
        for k, found in enumerate(cells):
            counts = np.zeros((len(rows[k]), len(langs)))
            if found:
                at, lang, n = np.array(found).T
                counts[at, lang] = n
            of = np.array([sums.get((lang, k), 0) for lang in langs], dtype=float)
            scores[k] = np.log((counts + 0.1) / (of + 0.1 * max(1, len(rows[k])))).astype(np.float32)
    return Model(langs, rows, scores, longest)


def identify(docs: DataFrame, model: Model, *keep: str | Column) -> DataFrame:
    """The columns to keep, lang_pred and score (the winner's share of the posterior, 0 to 1) for each text.

    A text that is null or has no letter is `und` with score 0, as is every text if nothing could be learned. Ties go
    to the language first by code point. Rows are judged one by one, so repeats, nulls elsewhere and other columns
    change nothing; columns to keep that are named lang_pred or score give way to the new ones.
    """
    kept = docs.select(*keep).drop("lang_pred", "score")
    own = "text" in kept.columns  # then the text goes to the workers only once
    shaped = kept if own else docs.select(*keep, F.col("text").alias("#text")).drop("lang_pred", "score")
    text_column = "text" if own else "#text"
    schema = StructType([*kept.schema.fields]).add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by vocabulary, n-gram lengths and languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(shared.value)
        names = np.array([*shared.value.langs, "und"], dtype=object)
        for whole in batches:
            for batch in slices(whole, text_column, 1 << 20):
                texts = batch.column(text_column).to_pylist()
                picks, scores = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
                for i, text in enumerate(texts):
                    found = words(text) if text and len(names) > 1 else ()
                    if not any(map(letters, found)):
                        continue
                    if len(rows) > CACHE:
                        rows = _Rows(shared.value)
                    at = np.array(list(map(rows.__getitem__, found)))
                    total = rows.matrix[at].sum(axis=0)
                    picks[i] = best = int(np.argmax(total))
                    scores[i] = 1 / np.exp(np.maximum(total - total[best], -700)).sum()
                columns = [batch.column(j) for j in range(batch.num_columns - (not own))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(names[picks], pa.string()), pa.array(scores)], schema.names)
        tidy()

    return shaped.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from training: crc32 of its doc_id as text is a multiple of the number of folds."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def language_id(docs: DataFrame, sample: int = 20_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document, learned from the rows that are not held out."""
    return identify(docs, train(docs.filter(~held_out()), sample), "doc_id", held_out().alias("held_out"))
