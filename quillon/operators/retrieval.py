"""Retrieval: dense and lexical ranked lists, their fusion, the scope floor, fit ranking, index refresh, grounding."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillon.functions import dates, search
from quillon.functions.text import emails_in
from quillon.functions.vectors import cosine_distance, doubles
from quillon.operators.keyed import first_rows
from quillon.operators.storage import settled

# Constants of fusion and ranking, and what states a count of records in lower-cased prose.
RRF_K, POOL, FLOOR = 60, 20, 0.64
COUNT_AFTER = "\\b(\\d{1,3})\\s+(?:\\*\\*)?(?:family off|multi-family|record|firm|result|match)"
COUNT_BEFORE = "(?:there are|a total of|count of|found)\\s+(?:\\*\\*)?(\\d{1,3})"
#: Queries that a record is compared with at once, and how many a task holds as one matrix.
BLOCK, MATRIX = 256, 16_384
#: Into how many parts rows are dealt at most, of which each gives its best of each query: more of them would give out more.
PARTS = 64
#: Distances that a task takes at once: queries times records.
CELLS = 2_000_000
#: Postings of a block of documents, which a task holds.
POSTINGS = 3_000_000
#: Bytes of text that are split into words at once.
BYTES = 1 << 22
WEIGHTS = {"semantic": 0.35, "sector": 0.25, "confidence": 0.15, "reachability": 0.15, "signals": 0.10}
_WORD = np.zeros(256, dtype=bool)
_WORD[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)] = True


def distances(index: DataFrame, queries: DataFrame) -> DataFrame:
    """Every record of the index (id, vector) against each query (query, vector), however many there are.

    The queries are dealt into blocks of about BLOCK, and each record meets each block once; no vector reaches the driver.
    """
    blocks = F.lit(max(1, -(-queries.count() // BLOCK)))
    asked = queries.select("query", doubles(F.col("vector")).alias("qv")).groupBy(F.pmod(F.xxhash64("query"), blocks).alias("block")).agg(F.collect_list(F.struct("query", "qv")).alias("qs"))
    each = index.select("id", doubles(F.col("vector")).alias("v")).crossJoin(asked.select("qs")).select("id", "v", F.explode("qs").alias("q"))
    return each.select(F.col("q.query").alias("query"), "id", cosine_distance(F.col("v"), F.col("q.qv")).alias("distance"))


def _nearest(names: pa.Array, asked: np.ndarray, n: int, kind: pa.DataType):
    """Of each task's records the n nearest of each query, by exact distance and id; all that is held is n rows a query and a slice.

    A matrix product finds what may be among them; distances of that are then taken in the order of components, as
    cosine_distance takes them, so that rows of equal vectors have equal distances.
    """
    lists = pa.list_(pa.float64())
    length = np.sqrt(np.add.accumulate(asked * asked, axis=1)[:, -1])
    unit = asked / np.maximum(length, 1e-300)[:, None]

    def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
        both, own = np.zeros(len(q)), np.zeros(len(q))
        for j in range(asked.shape[1]):
            both += x[:, j] * asked[q, j]
            own += x[:, j] * x[:, j]
        with np.errstate(divide="ignore", invalid="ignore"):
            return 1 - both / (np.sqrt(own) * length[q])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit, step = np.full(len(asked), np.inf), max(n + 1, CELLS // len(asked))
        held, new, waiting = [], [], 0

        def best() -> list[tuple]:
            q, dist, ids = (np.concatenate(c) for c in zip(*held, *new))
            order = np.lexsort((ids, dist, q))
            q, dist, ids = q[order], dist[order], ids[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            limit[q[place == n - 1]] = dist[place == n - 1]
            return [(q[place < n], dist[place < n], ids[place < n])]

        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                x = part.column("vector").cast(lists).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                norm = np.sqrt((x * x).sum(axis=1))
                far = 1 - unit @ (x / np.where(norm == 0, 1, norm)[:, None]).T
                far[:, norm == 0] = np.inf
                bound = np.partition(far, n - 1, axis=1)[:, n - 1] if len(part) > n and np.isinf(limit).any() else np.inf
                near = (far <= np.minimum(limit, bound)[:, None] + 1e-9) & (norm > 0)[None, :]
                q, i = np.nonzero(near)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                for a in range(0, len(q), CELLS // 64):
                    some = slice(a, a + CELLS // 64)
                    new.append((q[some], exact(q[some], x[i[some]]), ids[i[some]]))
                waiting += len(q)
                if waiting > n * len(asked):  # as many as are held, so that a row is sorted few times
                    held, new, waiting = best(), [], 0
        for q, dist, ids in best() if held or new else []:
            for at in range(0, len(q), 100_000):
                cut = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(q[cut])), pa.array(ids[cut], kind), pa.array(dist[cut])], ["query", "id", "distance"])

    return run


def in_turn(columns: dict[str, str], tasks: int, *sides: tuple[DataFrame, Column]) -> DataFrame:
    """(side, columns): the rows of several sides, each row in all the tasks of an array of numbers; a task reads side 0 first, then side 1 and so on."""
    out = None
    for number, (rows, places) in enumerate(sides):
        held = [F.col(c) if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in columns.items()]
        part = rows.select(F.explode(places).alias("part"), F.lit(number).alias("side"), *held)
        out = part if out is None else out.unionByName(part)
    return out.repartitionById(tasks, "part").sortWithinPartitions("side").drop("part")


def grid(chunk: str, row: str, chunks: int, parts: int) -> tuple[Column, Column]:
    """The tasks of what is asked, by its chunk, and of rows, by their part: part p meets chunk c in task c * parts + p."""
    c, p = F.pmod(F.xxhash64(chunk), F.lit(chunks)).cast("int"), F.pmod(F.xxhash64(row), F.lit(parts)).cast("int")
    return F.sequence(c * parts, c * parts + parts - 1), F.sequence(p, p + parts * (chunks - 1), F.lit(parts))


def _nearest_in_turn(n: int, kind: pa.DataType):
    """A task's queries (side 0) as one matrix, and of its records (side 1) the n nearest of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = []

        def records() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                first = int(np.searchsorted(batch.column("side").to_numpy(), 1))
                if first:
                    asked.append(batch.slice(0, first))
                if first < len(batch):
                    yield batch.slice(first)

        rows = records()
        for one in rows:
            if asked:  # a chunk may be empty
                names = pa.concat_arrays([b.column("query") for b in asked])
                matrix = pa.concat_arrays([b.column("vector") for b in asked]).flatten().to_numpy(zero_copy_only=False).reshape(len(names), -1)
                yield from _nearest(names, matrix, n, kind)(chain([one], rows))

    return run


def dense(index: DataFrame, queries: DataFrame, n: int = POOL) -> DataFrame:
    """(query, id, distance, rank): the n nearest of each query; each task keeps its n nearest before anything is shuffled.

    Up to MATRIX queries, which is checked, go to all tasks as one matrix. More are dealt into chunks of about as many,
    and records into parts; a task reads a chunk, then streams a part. Vectors are compared with those of their length;
    null and zero ones of the index are never near.
    """
    asked, rows = (x.filter(F.size("vector") > 0).select(k, doubles(F.col("vector")).alias("vector")) for x, k in ((queries, "query"), (index, "id")))
    held = asked.limit(MATRIX + 1).collect()
    if not held:
        far = distances(index.limit(0), queries)
    else:
        kinds, far = dict(index.dtypes) | dict(queries.dtypes), None
        kind, shape = to_arrow_type(index.schema["id"].dataType), f"query {kinds['query']}, id {kinds['id']}, distance double"
        many = len(held) > MATRIX
        if many:
            asked = settled(asked, "queries")
            sizes = {r["width"]: r["count"] for r in asked.groupBy(F.size("vector").alias("width")).count().collect()}
        else:
            sizes = dict.fromkeys(len(r["vector"]) for r in held)
        for width, count in sizes.items():
            of_width = rows.filter(F.size("vector") == width)
            if many:
                chunks = -(-count // MATRIX)
                own, places = grid("query", "id", chunks, PARTS)
                columns = {"query": kinds["query"], "id": kinds["id"], "vector": "array<double>"}
                part = in_turn(columns, PARTS * chunks, (asked.filter(F.size("vector") == width), own), (of_width, places)).mapInArrow(_nearest_in_turn(n, kind), shape)
            else:
                own = [r for r in held if len(r["vector"]) == width]
                names = pa.array([r["query"] for r in own], to_arrow_type(queries.schema["query"].dataType))
                part = of_width.mapInArrow(_nearest(names, np.array([r["vector"] for r in own]), n, kind), shape)
            far = part if far is None else far.unionByName(part)
    return first_rows(far, ["query"], n, F.asc("distance"), F.asc("id")).withColumnRenamed("#n", "rank")


def in_scope(ranked: DataFrame, floor: float = FLOOR) -> DataFrame:
    """(query, nearest, in_scope) from ranked records: a query whose nearest is farther than the floor is refused."""
    return ranked.groupBy("query").agg(F.min("distance").alias("nearest")).withColumn("in_scope", F.col("nearest") <= floor)


def inverted_index(docs: DataFrame) -> DataFrame:
    """(term, id, tf): how often each stemmed term stands in each document (id, text)."""
    # Words are exploded before they are tested, as that is compiled and a function over an array is not.
    words = docs.select("id", F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("word")).filter((F.col("word") != "") & ~F.col("word").isin(search.STOPWORDS))
    counted = words.groupBy("id", "word").agg(F.count("*").alias("n"))
    single = counted.select("id", search.singular(F.col("word")).alias("single"), "n")
    return single.groupBy(search.without_ending(F.col("single")).alias("term"), "id").agg(F.sum("n").alias("tf"))


def split_words(texts: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Of lower-cased texts, some at a time: the first one's number, all their words, and where the words of each begin (one more at the end)."""
    texts = texts.cast(pa.string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + BYTES, side="right")) - 1)
        some, bounds = data[ends[at] : ends[stop]], ends[at : stop + 1] - ends[at]
        kept = _WORD[some]
        first = kept.copy()
        first[1:] &= ~kept[:-1]
        begins = bounds[:-1][bounds[:-1] < len(some)]
        first[begins] = kept[begins]
        starts, letters = np.flatnonzero(first), some[kept]
        offsets = np.append(np.cumsum(kept, dtype=np.int32)[starts] - 1, len(letters)).astype(np.int32)
        yield at, pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)), np.searchsorted(starts, bounds)
        at = stop


def _counts(group: np.ndarray, words: pa.Array, n: np.ndarray | None = None) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(group, word, n): how often each word stands in each group of numbers, or the sums of n."""
    coded = words.dictionary_encode()
    key = group.astype(np.int64) * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
    keys, own = np.unique(key, return_inverse=True)
    sums = np.bincount(own, n, len(keys)).astype(np.int64)
    group, code = np.divmod(keys, max(1, len(coded.dictionary)))
    return group, coded.dictionary.take(pa.array(code)), sums


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, word, n) of texts (id, text); the rows of a text follow one another."""
    for batch in batches:
        for start, words, bounds in split_words(batch.column("text")):
            doc, word, n = _counts(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), words)
            ids = batch.column("id").slice(start, len(bounds) - 1).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays([ids, word, pa.array(n)], ["id", "word", "n"])
    pa.default_memory_pool().release_unused()  # else an idle worker keeps it


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, id, tf) of rows (id, term, n), in which those of an id follow one another."""
    held = None
    for batch in chain(batches, [None]):
        rows = pa.concat_batches([x for x in (held, batch) if x is not None]) if held is not None or batch is not None else None
        if rows is None or not len(rows):
            continue
        ids = rows.column("id")
        codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        whole = len(rows) if batch is None else int(starts[-1])  # the last id may go on
        held = rows.slice(whole)
        if not whole:
            continue
        run = np.searchsorted(starts, np.arange(whole), side="right") - 1
        doc, term, tf = _counts(run, rows.column("term").slice(0, whole), rows.column("n").to_numpy()[:whole])
        yield pa.RecordBatch.from_arrays([term, ids.take(pa.array(starts[doc])), pa.array(tf)], ["term", "id", "tf"])
    pa.default_memory_pool().release_unused()


def index_of_texts(docs: DataFrame) -> DataFrame:
    """inverted_index of documents (id, text) with one row for each id: a task counts a text's words and terms, so nothing is shuffled."""
    kind = dict(docs.dtypes)["id"]
    counted = docs.select("id", F.lower("text").alias("text")).mapInArrow(_counted, f"id {kind}, word string, n long").filter(~F.col("word").isin(search.STOPWORDS))
    single = counted.select("id", search.singular(F.col("word")).alias("single"), "n")
    return single.select("id", search.without_ending(F.col("single")).alias("term"), "n").mapInArrow(_gathered, f"term string, id {kind}, tf long")


def query_sets(asked: DataFrame, name: str) -> DataFrame:
    """(own, terms, queries): the different sets of terms of queries (query, term), each under the least of its queries."""
    each = asked.groupBy("query").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    return settled(each.groupBy("terms").agg(F.min("query").alias("own"), F.collect_list("query").alias("queries")), name)


def asked_for(index: DataFrame, sets: DataFrame) -> DataFrame:
    """Postings of the terms of sets."""
    return index.join(sets.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi")


def by_blocks(index: DataFrame, sets: DataFrame, many: int):
    """Postings dealt by document into blocks, and all sets beside each block."""
    left = index.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(many)).cast("int"))
    right = sets.select("own", "terms", F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("block"))
    return left.groupBy("block").cogroup(right.groupBy("block"))


class Postings:
    """The postings of a block in order of (term, document): terms are numbers, documents places among the ids; sets are ranges of `asked`."""

    def __init__(self, ids: np.ndarray, code: np.ndarray, doc: np.ndarray, terms: int, asked: np.ndarray, starts: np.ndarray):
        self.ids, self.doc, self.asked, self.starts = ids, doc, asked, starts
        self.bound = np.searchsorted(code, np.arange(terms + 1))

    @classmethod
    def of(cls, rows: pa.Table, sets: pa.Table) -> Postings:
        """Of rows (term, id) in any order, which `order` puts in order, and sets (terms)."""
        term = rows.column("term").combine_chunks().dictionary_encode()
        ids, doc = np.unique(rows.column("id").to_numpy(), return_inverse=True)
        code = term.indices.to_numpy(zero_copy_only=False)
        order = np.lexsort((doc, code))
        terms = sets.column("terms").combine_chunks()
        asked = pc.index_in(terms.flatten(), term.dictionary).fill_null(-1).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False))]).astype(np.int64)
        held = cls(ids, code[order], doc[order], len(term.dictionary), asked, starts)
        held.order = order
        return held

    def matches(self):
        """(set, docs, rows): of each set the documents that hold all its terms, and of each term their rows in order of (term, id)."""
        wide = {}
        for k, (a, b) in enumerate(zip(self.starts, self.starts[1:])):
            codes = self.asked[a:b]
            if not len(codes) or codes.min() < 0:
                continue
            codes = codes[np.argsort(self.bound[codes + 1] - self.bound[codes], kind="stable")]
            docs = self.doc[self.bound[codes[0]] : self.bound[codes[0] + 1]]
            rows = [np.arange(self.bound[codes[0]], self.bound[codes[0] + 1])]
            for c in codes[1:]:
                if c not in wide:  # where each document stands in the list of a term
                    own = self.doc[self.bound[c] : self.bound[c + 1]]
                    if 16 * len(own) > len(self.ids):
                        wide[c] = np.full(len(self.ids), -1, np.int32)
                        wide[c][own] = np.arange(len(own))
                if c in wide:
                    at = wide[c][docs]
                else:
                    at = np.searchsorted(own := self.doc[self.bound[c] : self.bound[c + 1]], docs)
                    at = np.where(own[np.minimum(at, len(own) - 1)] == docs, at, -1)
                held = at >= 0
                docs, rows = docs[held], [r[held] for r in rows] + [self.bound[c] + at[held]]
                if not len(docs):
                    break
            if len(docs):
                yield k, docs, rows


def best_rows(score: np.ndarray, n: int) -> np.ndarray:
    """The places of the n greatest, ties in order."""
    if len(score) > n:
        near = np.flatnonzero(score >= -np.partition(-score, n - 1)[n - 1])
        return near[np.argsort(-score[near], kind="stable")][:n]
    return np.argsort(-score, kind="stable")


def _most(n: int, own: pa.DataType, kind: pa.DataType):
    """Of each set of terms the n documents of a block with the greatest product of frequencies; ties by id."""

    def run(rows: pa.Table, sets: pa.Table) -> pa.Table:
        none = pa.table({"own": pa.array([], own), "id": pa.array([], kind), "p": pa.array([], pa.float64())})
        if not len(rows) or not len(sets):
            return none
        held = Postings.of(rows, sets)
        tf = rows.column("tf").to_numpy().astype(np.float64)[held.order]
        found, ids, products = [], [], []
        for k, docs, at in held.matches():
            p = tf[at[0]]
            for r in at[1:]:
                p = p * tf[r]
            top = best_rows(p, n)
            found.append(np.full(len(top), k))
            ids.append(held.ids[docs[top]])
            products.append(p[top])
        if not found:
            return none
        names = sets.column("own").combine_chunks().take(pa.array(np.concatenate(found)))
        return pa.table({"own": names, "id": pa.array(np.concatenate(ids), kind), "p": pa.array(np.concatenate(products))})

    return run


def lexical(index: DataFrame, queries: DataFrame, n: int = POOL, living: DataFrame | None = None) -> DataFrame:
    """(query, id, score, rank) of documents that hold all terms of a query (query, text), stemmed; a query without terms finds nothing.

    index is (term, id, tf); only rows of a query's terms are read on. The score is the sum of 1 + ln of each frequency,
    taken as the logarithm of their product, which is exact, so that equal scores are equal. Of an index in segments,
    postings count whose (id, segment) is among the living. Postings are dealt by document into blocks, each of which
    gives the n best of each different set of terms; the rows that match are never shuffled.
    """
    words = queries.select("query", F.explode(F.array_distinct(search.terms(F.col("text")))).alias("word"))
    asked = words.select("query", search.stem(F.col("word")).alias("term"))
    sets, many = query_sets(asked, "asked"), max(1, -(-index.count() // POSTINGS))
    index = asked_for(index, sets)
    if living is not None:  # only now, so that the postings nobody asks for are not shuffled
        index = index.join(living, ["id", "segment"], "left_semi")
    types = dict(sets.dtypes) | dict(index.dtypes)
    run = _most(n, to_arrow_type(sets.schema["own"].dataType), to_arrow_type(index.schema["id"].dataType))
    each = by_blocks(index.select("term", "id", "tf"), sets, many).applyInArrow(run, f"own {types['own']}, id {types['id']}, p double")
    best = first_rows(each, ["own"], n, F.desc("p"), F.asc("id"))
    every = best.join(sets, "own").select(F.explode("queries").alias("query"), "id", (F.size("terms") + F.ln("p")).alias("score"), F.col("#n").alias("rank"))
    return every


def fused(vector: DataFrame, words: DataFrame, k: int = 10) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists (query, id, rank); ties go to the better vector rank, then the lexical one."""
    legs = vector.select("query", "id", F.col("rank").alias("v"), F.lit(None).cast("int").alias("l")).unionByName(words.select("query", "id", F.lit(None).cast("int").alias("v"), F.col("rank").alias("l")))
    both = legs.groupBy("query", "id").agg(F.max("v").alias("v"), F.max("l").alias("l"))
    part = lambda c: F.coalesce(1.0 / (RRF_K + F.col(c)), F.lit(0.0))
    scored = both.withColumn("score", part("v") + part("l"))
    matched = F.when(F.col("v").isNotNull() & F.col("l").isNotNull(), "both").when(F.col("v").isNotNull(), "vector").otherwise("lexical")
    return first_rows(scored, ["query"], k, F.desc("score"), F.asc_nulls_last("v"), F.asc_nulls_last("l")).select("query", "id", F.col("#n").alias("rank"), matched.alias("matched"))


def fit(records: DataFrame, mandate: list[float], sectors: list[str], today: Column) -> DataFrame:
    """Score and evidence tier of records (id, vector, sectors, prose, confidence, reachability, signal_date) for a mandate.

    strong needs a stated sector and confidence of 90, moderate any sector evidence, weak prose and likeness; the tier
    says what the record states, not how high it scores.
    """
    semantic = F.greatest(F.lit(0.0), 1 - cosine_distance(doubles(F.col("vector")), F.array(*map(F.lit, mandate))))
    sector, stated, any_hit = search.sector_evidence(sectors, F.col("sectors"), F.col("prose"))
    conf, reach = F.coalesce("confidence", F.lit(0)) / 100.0, F.coalesce("reachability", F.lit(0)) / 100.0
    parts = records.select("id", semantic.alias("semantic"), sector.alias("sector"), conf.alias("c"), reach.alias("r"), dates.recency(F.col("signal_date"), today).alias("signals"), stated.alias("stated"), any_hit.alias("hit"), (F.coalesce("prose", F.lit("")) != "").alias("told"))
    w = WEIGHTS
    score = w["semantic"] * F.col("semantic") + w["sector"] * F.col("sector") + w["confidence"] * F.col("c") + w["reachability"] * F.col("r") + w["signals"] * F.col("signals")
    tier = F.when(F.col("stated") & (F.col("c") >= 0.9), "strong").when(F.col("hit"), "moderate").when(F.col("told") & (F.col("semantic") >= 0.45), "weak").otherwise("insufficient_evidence")
    return parts.select("id", score.alias("score"), tier.alias("tier"), "semantic", "sector", "signals")


def index_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, change): embed what is new or changed, keep the rest, drop what is gone. old and new are (id, content)."""
    both = new.select("id", F.col("content").alias("now")).join(old.select("id", F.col("content").alias("was")), "id", "full")
    change = F.when(F.col("now").isNull(), "drop").when(F.col("was").isNull(), "add").when(F.col("was") == F.col("now"), "keep").otherwise("embed")
    return both.select("id", change.alias("change"))


def ungrounded_emails(answers: DataFrame, allowed: DataFrame) -> DataFrame:
    """(id, email): addresses in answers (id, text) that are not allowed (email, lower case)."""
    said = answers.select("id", F.explode(F.array_distinct(emails_in(F.col("text")))).alias("email"))
    return said.join(allowed.select("email").distinct(), "email", "left_anti")


def count_claims(text: Column) -> Column:
    """Numbers that a text states as a count of records."""
    low = F.lower(text)
    after, before = (F.regexp_extract_all(low, F.lit(p), F.lit(1)) for p in (COUNT_AFTER, COUNT_BEFORE))
    return F.transform(F.concat(after, before), lambda x: x.cast("int"))


def intent(text: Column) -> Column:
    """A deterministic router: counting questions are aggregates, names are lookups, anything else is discovery."""
    low = F.lower(text)
    return F.when(low.rlike("\\b(how many|count|total number|list all)\\b"), "aggregate").when(low.rlike("\\b(who is|tell me about|contact for|details on)\\b"), "lookup").otherwise("discovery")


def confusion(pairs: DataFrame) -> DataFrame:
    """tp, fp, fn, tn and the rates of (truth, predicted), both 0 or 1; a rate without cases is null."""
    cell = lambda t, p: F.count_if((F.col("truth") == t) & (F.col("predicted") == p))
    c = pairs.agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"))
    rate = lambda a, *b: F.try_divide(a, sum((F.col(x) for x in b), F.lit(0)))
    return c.select("*", rate(F.col("tp"), "tp", "fp").alias("precision"), rate(F.col("tp"), "tp", "fn").alias("recall"), rate(F.col("fp"), "fp", "tn").alias("fpr"), rate(F.col("tp") + F.col("tn"), "tp", "fp", "fn", "tn").alias("accuracy"))
