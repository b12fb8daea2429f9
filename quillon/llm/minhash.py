"""MinHash near-dedup with tensored banding.

Two small collections of sub-keys, each made of a few minimums, are computed for a document; every pair of one from
either collection is a table key. tables = side * side keys thus cost only 2 * side * rows minimums, about the square
root of what separate keys would. Documents of one set are one class before any table is built, and every link is
confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import U64, discard, lower_ascii, match, mix, prefix_hash, settle, slices, span_hash, text_bytes, tidy, word_bounds, word_codes
from quillon.llm.graph import components

#: A pair of similarity s shares a table with probability (1 - (1 - s**ROWS)**SIDE)**2: 0.997 at 0.8, 0.99998 at 0.9.
SIDE, ROWS = 9, 3
#: Bytes of text that a worker hashes at once.
SLICE = 1 << 20
#: Groups that are compared pair by pair are cut into blocks of about so many members, at most so many blocks, unless a
#: block would then hold more hashes than a task should: each member goes to as many tasks as its group has blocks.
BLOCK, BLOCKS, BLOCK_HASHES = 256, 64, 4 << 20
#: Rounds in which components are joined through one pivot for each table key, before what is left is compared in blocks.
PIVOTS = 2
_draw = np.random.default_rng(77)
_FACTORS = _draw.integers(1, 2**63, 2 * SIDE * ROWS, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_SHIFTS = _draw.integers(1, 2**63, 2 * SIDE * ROWS, dtype=np.int64).astype(U64)


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin."""
    buf, offsets = text_bytes(column)
    starts, ends, first = word_bounds(buf, offsets)
    codes = word_codes(lower_ascii(buf), starts, ends)
    n_words = np.diff(first)
    n = np.where(n_words > 0, np.maximum(n_words - words + 1, 1), 0)
    edges = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(n)), n)
    at = first[doc] + np.arange(edges[-1]) - edges[doc]
    hashes = mix(span_hash(prefix_hash(codes), at, np.minimum(at + words, first[doc + 1])))
    for a, b in zip(edges[:-1], edges[1:]):
        hashes[a:b].sort()
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.concatenate([[0], np.cumsum(new)])[edges]


def _per_text(hashes: np.ndarray, edges: np.ndarray, how) -> np.ndarray:
    """how.reduceat over each text's hashes; 0 for empty sets."""
    full = np.diff(edges) > 0
    out = np.zeros(len(edges) - 1, dtype=U64)
    if full.any():
        out[full] = how.reduceat(hashes, edges[:-1][full])
    return out


def _signatures(words: int, keep: tuple[str, ...] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                hashes, edges = shingle_sets(batch.column(1), words)
                least = np.stack([_per_text(hashes * a + b, edges, np.minimum) for a, b in zip(_FACTORS, _SHIFTS)])
                keys = least[::ROWS].copy()
                for r in range(1, ROWS):
                    keys = mix(keys) * U64(0x9E3779B97F4A7C15) + least[r::ROWS]
                columns = [batch.column(0), pa.array(np.diff(edges)), *(pa.array(_per_text(x, edges, np.add).view(np.int64)) for x in (mix(hashes), mix(hashes * _FACTORS[0])))]
                columns += [pa.array(mix(k).view(np.int64)) for k in keys] + [batch.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set1", "set2", *(f"k{i}" for i in range(2 * SIDE)), *keep])
        tidy()

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                hashes, edges = shingle_sets(batch.column(0), words)
                ids = [pa.array(_per_text(x, edges, np.add).view(np.int64)) for x in (mix(hashes), mix(hashes * _FACTORS[0]))]
                lists = pa.LargeListArray.from_arrays(pa.array(edges), pa.array(hashes.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*ids, lists], ["set1", "set2", "set"])
        tidy()

    return run


def overlaps(a: list[np.ndarray], b: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Size of the intersection of each set of a with each of b: products of 0/1 matrices over stretches of hashes."""
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b)]
    one, two = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    shared = np.intersect1d(one, two)
    out = np.zeros((len(a), len(b)), np.float32)
    at = [np.searchsorted(shared, x) for x in (one, two)]
    held = [(k < len(shared)) & (shared[np.minimum(k, len(shared) - 1)] == x) if len(shared) else np.zeros(len(x), bool) for k, x in zip(at, (one, two))]
    for lo in range(0, len(shared), columns):
        parts = []
        for k, has, row, n in zip(at, held, rows, out.shape):
            mine = has & (k >= lo) & (k < lo + columns)
            dense = np.zeros((n, columns), np.float32)
            dense[row[mine], k[mine] - lo] = 1
            parts.append(dense)
        out += parts[0] @ parts[1].T
    return out


def _compare(percent: int, step: int = 512):
    """Of two blocks of one group: links that join members of different components, none that follows from the others."""

    def run(table: pa.Table) -> pa.Table:
        low = table.column("block").to_numpy() == table.column("lo")[0].as_py()
        inner = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        lists = table.column("set").combine_chunks()
        flat, edges = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        pick = lambda at: [flat[edges[i] : edges[i + 1]] for i in at]
        node, size = table.column("node").to_numpy(), np.diff(edges)
        names, label = np.unique(table.column("label").to_numpy(), return_inverse=True)
        root = np.arange(len(names))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        # By size, so that most pairs of parts are too unlike in size to be compared at all.
        one, out = np.flatnonzero(low), []
        two = one if inner else np.flatnonzero(~low)
        one, two = one[np.argsort(size[one], kind="stable")], two[np.argsort(size[two], kind="stable")]
        for p in range(0, len(one), step):
            for q in range(0, len(two), step):
                a, b = one[p : p + step], two[q : q + step]
                if 100 * size[a[-1]] < percent * size[b[0]] or 100 * size[b[-1]] < percent * size[a[0]] or (inner and q < p):
                    continue
                here = np.array([find(x) for x in range(len(names))])[label] if len(names) <= 4 * step else label
                if (here[a][0] == here[a]).all() and (here[a][0] == here[b]).all():
                    continue
                both = overlaps(pick(a), pick(b))
                i, j = np.nonzero((100 * both >= percent * (size[a][:, None] + size[b][None, :] - both)) & (here[a][:, None] != here[b][None, :]))
                for s, t in zip(a[i].tolist(), b[j].tolist()):
                    x, y = find(label[s]), find(label[t])
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        out.append((node[s], node[t]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Links between components inside each group of candidates (node, label, group, set), block by block."""
    sizes = members.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.size("set")).alias("hashes"))
    many = F.greatest(F.least(F.ceil(F.col("n") / BLOCK), F.lit(BLOCKS)), F.ceil(F.col("hashes") / BLOCK_HASHES)).cast("int")
    placed = members.join(sizes.select("group", many.alias("blocks")), "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select("group", "node", "label", "set", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    # Dealt by pairs of blocks, or all pairs of a large group would be one task's.
    return paired.repartition("group", "lo", "hi").groupBy("group", "lo", "hi").applyInArrow(_compare(percent), "a long, b long")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets overlap enough: 100 * |both| >= percent * |either|."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("n", F.size(F.array_intersect("set_a", "set_b")))
    return both.filter(100 * F.col("n") >= percent * (F.size("set_a") + F.size("set_b") - F.col("n"))).select(*pairs.columns)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each document (doc_id, text).

    Texts are lower-cased in A-Z only and cut into words at ASCII white space; a set has the distinct runs of `words`
    words, of a shorter text the whole sequence. Documents are linked if 100 * |both| >= percent * |either|;
    component_id is the smallest doc_id reachable. Texts without words, and null texts, are linked with nothing.

    Equal sets are joined first. Each set is compared with the least set that it shares a table key with, then, in
    rounds, components that share a key through that key's pivot, one pair for two components. Keys whose members then
    still lie in different components join these into groups, which are compared whole, in blocks that pass on only
    links between components: no pair is written out that is not such a link, and no link between components is lost.
    The blocks cost the square of a group's different sets that no pivot could join. Rows that repeat a doc_id
    are told apart by their text; a null doc_id counts as larger than all others. An empty table gives no rows.
    """
    out = _judged(docs, words, percent)
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def _named(classes: DataFrame) -> DataFrame:
    """classes with `node`, one number for each (set1, set2): set1, or a hash of both where one set1 stands for several sets."""
    twins = classes.groupBy("set1").count().filter("count > 1").select("set1", F.lit(True).alias("twin"))
    node = F.when(F.col("twin"), F.xxhash64("set1", "set2")).otherwise(F.col("set1"))
    return settle(classes.join(twins, "set1", "left").withColumn("node", node).drop("twin"))


def _judged(docs: DataFrame, words: int, percent: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id, label of each row, and its long columns to keep; label tells components apart."""
    keys = [f"k{i}" for i in range(2 * SIDE)]
    kind = dict(docs.dtypes)["doc_id"]
    shape = f"doc_id {kind}, n_shingles long, set1 long, set2 long, " + ", ".join(f"`{k}` long" for k in [*keys, *keep])
    signed = settle(docs.select("doc_id", "text", *keep).mapInArrow(_signatures(words, keep), shape))
    full = signed.filter("n_shingles > 0")
    classes = settle(full.groupBy("set1", "set2").agg(F.min("doc_id").alias("first_id"), F.min("n_shingles").alias("n"), *(F.min(k).alias(k) for k in keys)))
    classes = _named(classes)
    tables = F.array(*(F.xxhash64(F.lit(i * SIDE + j), keys[i], keys[SIDE + j]) for i in range(SIDE) for j in range(SIDE)))
    rows = classes.select("node", F.explode(tables).alias("key"))
    shared = rows.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most").drop("most")
    members = settle(rows.join(shared, "key"))
    wanted = classes.join(members.select("node").distinct(), "node").select("first_id").distinct()
    found = match(docs.select("doc_id", "text"), wanted.withColumnRenamed("first_id", "doc_id"), ["doc_id"]).select("text").mapInArrow(_sets(words), "set1 long, set2 long, set array<long>")
    sets = settle(match(classes.select("set1", "set2", "node"), found, ["set1", "set2"]).select("node", "set").dropDuplicates(["node"]))
    sizes = sets.select("node", F.size("set").alias("size"))

    def linked(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b), with their other columns, those that are similar enough. Sets that differ too much in size
        cannot be, so what remains is worth fetching the sets for."""
        a, b = (sizes.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}")) for x in "ab")
        fit = 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")
        return settle(_confirm(pairs.join(a, "a").join(b, "b").filter(fit).select(*pairs.columns), sets, percent))

    nearest = members.filter("node <> least").groupBy("node").agg(F.min("least").alias("b"))
    labels = components(linked(nearest.select(F.col("node").alias("a"), "b")))

    def placed() -> DataFrame:
        """Members of the keys that still join different components, with the pivot of each key: its least member of the least component."""
        at = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
        pivots = at.groupBy("key").agg(F.min(F.struct("label", "node")).alias("pivot"), F.max("label").alias("hi"), F.count("*").alias("n")).filter("pivot.label < hi")
        return settle(at.join(pivots.select("key", "n", F.col("pivot.label").alias("lo"), F.col("pivot.node").alias("pivot")), "key"))

    def joined_by(edges: DataFrame) -> DataFrame:
        """The labels of all nodes after components (a, b) have been joined."""
        over = components(edges)
        told = labels.select("node", F.col("label").alias("was")).join(over.withColumnRenamed("node", "was"), "was", "left").select("node", F.coalesce("label", "was").alias("label"))
        single = over.join(labels.select("node"), "node", "left_anti")  # nodes that had no link yet are components of their own
        return settle(told.unionByName(single))

    for turn in range(PIVOTS + 1):
        at = placed()
        if turn == PIVOTS or at.isEmpty():
            break
        # Keys of two members are settled here, all others by one pair for two components.
        two = [F.when(F.col("n") == 2, f("node", "pivot")) for f in (F.least, F.greatest)]
        each = at.filter("label <> lo" if turn == 0 else "label <> lo and n > 2").groupBy("label", "lo", *two).agg(F.min(F.struct("node", "pivot")).alias("p"))
        more = linked(each.select(F.col("p.node").alias("a"), F.col("p.pivot").alias("b"), "label", "lo"))
        labels = joined_by(more.select(F.col("label").alias("a"), F.col("lo").alias("b")))
    open_ = at.filter("n > 2")  # of two members the pair is settled
    if not open_.isEmpty():
        groups = components(open_.filter("label <> lo").select(F.col("label").alias("a"), F.col("lo").alias("b")).distinct())
        labelled = open_.select("node", "label").distinct().join(groups.select(F.col("node").alias("label"), F.col("label").alias("group")), "label")
        own = labelled.select("node", F.col("label").alias("own"))
        more = settle(_across(labelled.join(sets, "node"), percent))
        if not more.isEmpty():
            ends = more.join(own.select(F.col("node").alias("a"), F.col("own").alias("la")), "a").join(own.select(F.col("node").alias("b"), F.col("own").alias("lb")), "b")
            labels = joined_by(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    discard(members, sets)
    joined = classes.join(labels, "node", "left").select("set1", "set2", "first_id", F.coalesce("label", "node").alias("label"))
    # Written out, so that the join below can split a component that holds very many classes.
    least = settle(joined.groupBy("label").agg(F.min("first_id").alias("component_id")))
    of_class = joined.join(least, "label").select("set1", "set2", "component_id", "label")
    out = signed.select("doc_id", "n_shingles", "set1", "set2", *keep).join(of_class, ["set1", "set2"], "left")
    return out.select("doc_id", "n_shingles", "component_id", "label", *keep)


def dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay: of each group of near copies the one with the smallest doc_id.

    Rows are told apart by doc_id and text. Those that share both are one document; different texts that share a doc_id,
    or have none, all stay unless they are copies of a kept one. Of a group with several texts of its smallest doc_id the
    one with the least hash stays. A text without words stays, unless its doc_id is that of a text with words that stays.
    """
    marked = docs.withColumn("#mark", F.xxhash64("text"))
    rows = settle(_judged(marked, words, percent, ("#mark",)))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "#mark")
    stay = rows.filter("n_shingles > 0").groupBy("label").agg(F.min(place).alias("p")).select("p.doc_id", F.col("p")["#mark"].alias("#mark"))
    bare = rows.filter("n_shingles = 0").select("doc_id", "#mark").distinct().join(stay.select("doc_id").distinct(), "doc_id", "left_anti")
    return match(marked, stay.union(bare), ["doc_id", "#mark"]).dropDuplicates(["doc_id", "#mark"]).drop("#mark")
