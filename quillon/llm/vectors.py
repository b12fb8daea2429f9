"""Embedding near-dedup by sorted projection passes, at every size.

In each pass vectors are put in the lexicographic order of 64 concatenated random hyperplane hashes around the mean, each
is compared with its neighbours in a bounded window, and pairs whose cosine is confirmed are united across passes. The
number of passes follows from how full the measured prefixes are; vectors so crowded that even many passes would not reach
the stated miss chance are compared with all others in blocks, as an exact way for the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import U64, match, partitions, settle
from quillon.llm.graph import components

BITS = 64
#: Columns of a row of a pass.
ROW = ["pass", "dim", "key", "node", "vector"]
#: Members of a component are compared exactly in blocks of about so many.
BLOCK = 512


#: Vectors that so many passes serve are left to the passes, whatever it would cost to compare them with all others.
LEAST = 64
#: Vectors that are compared exactly with all others come in blocks of about so many.
WIDE = 8192
#: What a pass costs for each vector (hash, sort, shuffle), counted in comparisons of two vectors.
PASS_COST = 4096
#: Passes of keys alone in which the occupancy of prefixes is measured.
PROBES = 4
#: Chances of sharing a window are kept as bins of -STEPS * log2(chance); the last bin is never left to the passes.
STEPS, LAST = 4, 200


def passes_for(bins: dict[int, int], miss: float) -> tuple[int, int]:
    """Passes, and the last bin that they serve: every served vector misses a partner at the threshold with a chance of at
    most `miss`. All bins that LEAST passes can serve are served; beyond, as many as cost less so than by comparing their
    vectors with the whole table. There is always a pass; a last bin of -1 says that it serves none for sure."""
    turns = {b: max(1, math.ceil(math.log(miss) / math.log1p(-(2.0 ** (-(b + 1) / STEPS))))) for b in bins if b < LAST}
    first = max((b for b in turns if turns[b] <= LEAST), default=-1)
    left = lambda last: sum(n for b, n in bins.items() if b > last)
    options = [(float(turns.get(b, 1)) * PASS_COST + left(b), turns.get(b, 1), b) for b in {first, *(b for b in turns if b > first)}]
    return min(options)[1:]


def unit(column: pa.Array, dim: int) -> np.ndarray:
    """Rows scaled to length 1, in double precision; scaled by the largest component first, against overflow."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each length of vector: the sum of the unit vectors, and how many there are."""
    sums: dict[int, np.ndarray] = {}
    counts: dict[int, int] = {}
    for batch in batches:
        sizes = batch.column("dim").to_numpy()
        for dim in np.unique(sizes).tolist():
            x = unit(batch.filter(pa.array(sizes == dim)).column("vector"), dim)
            sums[dim] = sums.get(dim, 0) + x.sum(axis=0)
            counts[dim] = counts.get(dim, 0) + len(x)
    for dim, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(total), pa.array(np.full(dim, counts[dim], np.int64))], ["dim", "at", "total", "n"])


def _means(classes: DataFrame) -> dict[int, np.ndarray]:
    """The mean unit vector of each length."""
    sums = classes.select("dim", "vector").mapInArrow(_sums, "dim int, at int, total double, n long").groupBy("dim", "at").agg((F.sum("total") / F.sum("n")).alias("mean"))
    out: dict[int, list[tuple[int, float]]] = {}
    for dim, at, mean in sums.collect():
        out.setdefault(dim, []).append((at, mean))
    return {dim: np.array([m for _, m in sorted(ms)]) for dim, ms in out.items()}


def _hashes(x: np.ndarray, mean: np.ndarray, seed: int, p: int) -> np.ndarray:
    weights = U64(1) << np.arange(BITS, dtype=U64)[::-1]
    planes = np.random.default_rng([seed, p, x.shape[1]]).standard_normal((x.shape[1], BITS))
    return (((x - mean) @ planes > 0) * weights).sum(axis=1, dtype=U64).view(np.int64)


def _keys(passes: int, seed: int, means: dict[int, np.ndarray]):
    """Each vector once a pass, with its key of that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                x = unit(part.column("vector"), dim)
                for p in range(passes):
                    key = pa.array(_hashes(x, means[dim], seed, p))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), part.column("dim"), key, part.column("node"), part.column("vector")], ["pass", "dim", "key", "node", "vector"])

    return run


def _probe_keys(seed: int, means: dict[int, np.ndarray], cosine: float):
    """Keys of the probes, and the least chance that a partner at the threshold agrees with the vector in one hash.

    The partner lies at most `reach` away; seen from the mean, at a distance r, that is an angle of up to
    arcsin(reach / r), and any angle if the vector is nearer to the mean than that.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                x = unit(part.column("vector"), dim)
                r = np.sqrt(((x - means[dim]) ** 2).sum(axis=1))
                agree = np.where(r > reach, 1 - np.arcsin(np.minimum(1, reach / np.maximum(r, 1e-12))) / np.pi, 0.0)
                for p in range(PROBES):
                    key = pa.array(_hashes(x, means[dim], seed + 1, p))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), part.column("dim"), key, part.column("node"), pa.array(agree)], ["pass", "dim", "key", "node", "agree"])

    return run


def _occupancy(window: int):
    """Of sorted keys: for each vector the chance that a partner at the threshold stands within `window` rows.

    That is certain if both share a prefix whose rows all lie within the window: one bit more than what is shared with
    the rows `window` before and behind. Rows that have neither in this stretch are not measured.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if sum(map(len, held)) <= window:
            return
        table = pa.Table.from_batches(held)
        group = table.column("pass").to_numpy().astype(np.int64) * (1 << 32) + table.column("dim").to_numpy()
        key, node, agree = table.column("key").to_numpy().view(U64), table.column("node").to_numpy(), table.column("agree").to_numpy()
        bits = np.full(len(key), -1)
        differ = key[window:] ^ key[:-window]
        shared = np.full(len(differ), BITS)
        for b in range(BITS):
            shared -= (differ >> U64(b)) != 0
        shared = np.where(group[window:] == group[:-window], shared + 1, -1)
        bits[window:] = shared
        bits[: len(bits) - window] = np.maximum(bits[: len(bits) - window], shared)
        known = bits >= 0
        yield pa.RecordBatch.from_arrays([pa.array(node[known]), pa.array(agree[known] ** bits[known])], ["node", "chance"])

    return run


def _windows(cosine: float, window: int, ends: bool = True):
    """Links among neighbours of sorted rows; of all that are found in one stretch only those that join two groups.

    With `ends` the first and last `window` rows of the stretch are passed on too, so that pairs across the borders of
    stretches can be compared.
    """

    def links(x: np.ndarray, nodes: np.ndarray, behind: int) -> list[tuple[int, int]]:
        """Compare rows from `behind` on with the `window` rows before each, and unite."""
        root = np.arange(len(nodes))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        out, rough = [], x.astype(np.float32)
        for a in range(0, len(x), window):
            lo = max(0, a - window)
            close = np.argwhere(rough[a : a + window] @ rough[lo : a + window].T >= cosine - 1e-3)
            i, j = close[:, 0] + a, close[:, 1] + lo
            take = (j < i) & (i - j <= window) & (i >= behind)
            i, j = i[take], j[take]
            true = (x[i] * x[j]).sum(axis=1) >= cosine if len(i) else np.zeros(0, bool)
            for s, t in zip(i[true].tolist(), j[true].tolist()):
                s, t = find(s), find(t)
                if s != t:
                    root[max(s, t)] = min(s, t)
                    out.append((s, t))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, np.ndarray, np.ndarray] | None = None
        total, tail = 0, None
        for batch in batches:
            if len(batch) == 0:
                continue
            if ends:
                if total < window:
                    yield edge(batch.slice(0, window - total))
                rows = pa.Table.from_batches([batch])
                tail = (rows if tail is None else pa.concat_tables([tail, rows])).slice(max(0, (0 if tail is None else len(tail)) + len(rows) - window)).combine_chunks()
                total += len(batch)
            group = batch.column("pass").to_numpy().astype(np.int64) * (1 << 32) + batch.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(group)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                x, nodes = unit(part.column("vector"), int(part.column("dim")[0].as_py())), part.column("node").to_numpy()
                behind = 0
                if held is not None and held[0] == group[a]:
                    behind = len(held[2])
                    x, nodes = np.concatenate([held[1], x]), np.concatenate([held[2], nodes])
                found = links(x, nodes, behind)
                held = (group[a], x[-window:], nodes[-window:])
                one, two = (nodes[[f[k] for f in found]] if found else np.zeros(0, np.int64) for k in (0, 1))
                yield link(one, two, batch)
        if total > window:  # what is not among the first rows already
            for piece in tail.slice(len(tail) - min(window, total - window)).to_batches():
                yield edge(piece)

    def edge(rows: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.nulls(len(rows), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, *(rows.column(c) for c in ROW)], ["a", "b", *ROW])

    def link(one: np.ndarray, two: np.ndarray, like: pa.RecordBatch) -> pa.RecordBatch:
        rest = [pa.nulls(len(one), like.schema.field(c).type) for c in ROW] if ends else []
        return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), *rest], ["a", "b", *ROW] if ends else ["a", "b"])

    return run


def _across(cosine: float):
    """Of two blocks: links between them (or within, if they are one), of all that are found only those that join two groups."""

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        nodes = np.unique(np.concatenate([one.column("node").to_numpy(), two.column("node").to_numpy()]))
        out: list[tuple[int, int]] = []
        if len(one) and len(two):
            dim = int(one.column("dim")[0].as_py())
            x, y = unit(one.column("vector"), dim), unit(two.column("vector"), dim)
            ix, iy = np.searchsorted(nodes, one.column("node").to_numpy()), np.searchsorted(nodes, two.column("node").to_numpy())
            label, rough = np.arange(len(nodes)), y.astype(np.float32)
            for lo in range(0, len(x), 512):
                i, j = np.nonzero(x[lo : lo + 512].astype(np.float32) @ rough.T >= cosine - 1e-3)
                starts = np.searchsorted(i, np.arange(len(x[lo : lo + 512]) + 1))
                for row in np.flatnonzero(np.diff(starts)).tolist():
                    near = j[starts[row] : starts[row + 1]]
                    near = near[(label[iy[near]] != label[ix[lo + row]])]
                    if not len(near):
                        continue
                    near = iy[near[(y[near] * x[lo + row]).sum(axis=1) >= cosine]]
                    groups, at = np.unique(label[near], return_index=True)
                    if len(groups):
                        out += [(nodes[ix[lo + row]], nodes[k]) for k in near[at]]
                        label[np.isin(label, groups)] = label[ix[lo + row]]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _against_all(classes: DataFrame, n: int, some: DataFrame, m: int) -> tuple[DataFrame, DataFrame]:
    """Two sides of block pairs: `some` of the classes (m nodes) against all n."""
    blocks = lambda k: max(1, -(-k // WIDE))
    dealt = lambda k: F.pmod(F.xxhash64("mark"), F.lit(blocks(k))).cast("int")
    one = classes.join(some, "node", "left_semi").select("dim", "node", "vector", dealt(m).alias("lo")).withColumn("hi", F.explode(F.sequence(F.lit(0), F.lit(blocks(n) - 1))))
    two = classes.select("dim", "node", "vector", dealt(n).alias("hi")).withColumn("lo", F.explode(F.sequence(F.lit(0), F.lit(blocks(m) - 1))))
    return one.toDF(*one.columns), two  # new names for the same columns, or the two sides could not be told apart


def find_links(classes: DataFrame, n: int, cosine: float, window: int, miss: float, passes: int | None, seed: int) -> DataFrame:
    """(a, b): links that join all classes (dim, node, mark, vector) with cosine >= the threshold into their components."""
    spark = classes.sparkSession

    def compared(some: DataFrame, m: int) -> DataFrame:
        one, two = _against_all(classes, n, some, m)
        keys = ["dim", "lo", "hi"]
        return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(_across(cosine), "a long, b long")

    means, hard, left = _means(classes), None, 0
    if passes is None and n <= window:
        passes = 1  # all vectors of a length stand in one window
    if passes is None:
        turns = max(1, min(partitions(spark), n * PROBES // (16 * window)))
        probed = classes.select("dim", "node", "vector").mapInArrow(_probe_keys(seed, means, cosine), "pass int, dim int, key long, node long, agree double")
        ordered = probed.repartitionByRange(turns, "pass", "dim", "key", "node").sortWithinPartitions("pass", "dim", "key", "node")
        chances = ordered.mapInArrow(_occupancy(window), "node long, chance double").groupBy("node").agg(F.avg("chance").alias("chance"))
        bin_ = F.when(F.col("chance") > 0, F.least(F.lit(LAST), F.floor(-STEPS * F.log2("chance")))).otherwise(LAST).cast("int")
        rated = settle(classes.select("node").join(chances, "node", "left").select("node", bin_.alias("bin")))
        bins = {r["bin"]: r["n"] for r in rated.groupBy("bin").agg(F.count("*").alias("n")).collect()}
        passes, served = passes_for(bins, miss)
        hard, left = rated.filter(F.col("bin") > served), sum(k for b, k in bins.items() if b > served)
    item = dict(classes.dtypes)["vector"]
    row = f"pass int, dim int, key long, node long, vector {item}"
    keyed = classes.select("dim", "node", "vector").mapInArrow(_keys(passes, seed, means), row)
    ordered = keyed.repartitionByRange(partitions(spark), "pass", "dim", "key", "node").sortWithinPartitions("pass", "dim", "key", "node")
    found = settle(ordered.mapInArrow(_windows(cosine, window), f"a long, b long, {row}"))
    # The ends of all stretches of a pass, in order: what lies within a window across borders does so here too.
    ends = found.filter("node is not null").select(*ROW).repartition("pass", "dim").sortWithinPartitions("pass", "dim", "key", "node")
    links = found.filter("a is not null").select("a", "b").union(ends.mapInArrow(_windows(cosine, window, ends=False), "a long, b long"))
    return settle((links.union(compared(hard, left)) if left else links).distinct())


def _count(cosine: float):
    """Of two blocks of one component: how many vectors each vector is linked with in the other block, copies counted."""

    def run(table: pa.Table) -> pa.Table:
        x = unit(table.column("vector"), int(table.column("dim")[0].as_py()))
        first = table.column("block").to_numpy() == table.column("lo")[0].as_py()
        copies, nodes = table.column("copies").to_numpy(), table.column("node").to_numpy()
        inner = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        a = np.flatnonzero(first)
        b = a if inner else np.flatnonzero(~first)
        near = x[a] @ x[b].T >= cosine
        if inner:
            np.fill_diagonal(near, False)
            return pa.table({"node": nodes[a], "linked": near @ copies[b]})
        return pa.table({"node": np.concatenate([nodes[a], nodes[b]]), "linked": np.concatenate([near @ copies[b], near.T @ copies[a]])})

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, window: int = 128, miss: float = 1e-3, passes: int | None = None, seed: int = 5) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding).

    Equal vectors, told apart by two 64-bit hashes, are one class. Classes go through as many passes as their measured
    crowding needs, or through `passes` where stated. Components of the links found are then compared exactly,
    block by block, so that n_links counts every vector of the component with cosine >= the threshold (other vectors,
    copies included), however many there are. Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different length. component_id is the smallest vec_id reachable. Rows that
    repeat a vec_id count as vectors of their own; a null vec_id counts as larger than all others. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").alias("vector")).withColumn("good", usable(F.col("vector")))
    marks = [F.when(F.col("good"), F.xxhash64("vector")).alias("node"), F.when(F.col("good"), F.xxhash64(F.lit(1), "vector")).alias("mark")]
    ids = settle(rows.select("vec_id", *marks))
    counted = ids.filter("node is not null").groupBy("node", "mark").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    data = rows.filter("good").select(*marks, "vector").groupBy("node", "mark").agg(F.first("vector").alias("vector"))
    classes = settle(counted.join(data, ["node", "mark"]).withColumn("dim", F.size("vector")))
    n = classes.count()
    links = find_links(classes, n, cosine, window, miss, passes, seed)
    labels = components(links)
    members = classes.join(labels, "node")
    sizes = labels.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "label").withColumn("block", F.pmod(F.xxhash64("mark"), F.col("blocks").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = placed.select("label", "node", "dim", "copies", "block", "vector", other.alias("other")).select("*", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    exact = paired.groupBy("label", "lo", "hi").applyInArrow(_count(cosine), "node long, linked long")
    linked = exact.groupBy("node").agg(F.sum("linked").alias("linked"))
    of_label = members.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = classes.drop("vector").join(labels, "node", "left").join(of_label, "label", "left").join(linked, "node", "left")
    facts = of_class.select("node", "mark", F.coalesce("component_id", "first_id").alias("component"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"))
    out = match(ids, facts, ["node", "mark"], "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))
