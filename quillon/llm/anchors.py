"""Finding windows that repeat anywhere in a corpus, exactly, without comparing all pairs.

Every window of `length` units (words or bytes) selects one anchor, the least hash among its runs of `part` units; equal
windows select equal anchors at equal places. Consecutive windows with one anchor form a segment. Segments meet by their
anchor: equal segments are settled by their hash, and only anchors that are seen in different surroundings (variants)
are passed on with their texts, to be compared by the method of the caller. A group of variants that is too large for
one task is compared window by window instead, dealt by the windows' own hashes, so nothing is capped or dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import BYTE_CODE, U64, match, mix, partitions, prefix_hash, settle, slices, span_hash, text_bytes, word_bounds, word_codes

#: Positions take the low bits of a selection value; hashes the rest.
_LOW = (1 << 28) - 1
#: A piece of input in which an anchor has more surroundings than this sends its windows; so does an anchor that has
#: more than GROUP surroundings altogether.
LOCAL_HOT, GROUP = 32, 512
#: Rows, and bytes of the texts of variants (a shard), that a task takes into memory at once, in whole groups of an anchor.
ROWS_AT_ONCE, SHARD = 500_000, 2 << 20
SEGMENT, CUT, ASK, HOT, MARK = range(5)
_NO_ID = -(2**63)
ROW = "kind int, bucket int, h long, g long, doc long, mark long, start long, stop long, known int"
_NAMES = [x.split()[0] for x in ROW.split(", ")]


@dataclass(frozen=True)
class Spec:
    unit: str  # "word" or "byte"
    length: int
    part: int
    keep_first: bool  # whether the earliest of equal windows stays

    @property
    def slice_bytes(self) -> int:
        return 4 << 20 if self.unit == "word" else 2 << 20


class Units:
    """The units of a few texts, as 64-bit codes with prefix hashes, and where each text's begin."""

    def __init__(self, column: pa.Array, spec: Spec):
        self.buf, offsets = text_bytes(column)
        if spec.unit == "word":
            self.starts, self.ends, self.first = word_bounds(self.buf, offsets)
            codes = word_codes(self.buf, self.starts, self.ends)
        else:
            self.first, codes = offsets, BYTE_CODE[self.buf]
        self.n = len(codes)
        self.one, self.two = prefix_hash(codes, 0), prefix_hash(codes, 1)

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return mix(span_hash(self.one, start, stop, 0)), mix(span_hash(self.two, start, stop, 1))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def segments(u: Units, spec: Spec) -> tuple[np.ndarray, ...]:
    """(text, first window start, last window start, anchor) of each segment; positions run over all texts of u."""
    n, k, width = u.n, spec.part, spec.length - spec.part + 1
    valid = np.zeros(n + 2, dtype=np.int8)
    long = np.flatnonzero(np.diff(u.first) >= spec.length)
    if not len(long):
        return (np.zeros(0, np.int64),) * 4
    valid[u.first[long]] += 1
    valid[u.first[long + 1] - spec.length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(valid[:n], dtype=np.int8))
    at = np.arange(n - k + 1)
    value = mix(span_hash(u.one, at, at + k)) & ~U64(_LOW) | at.astype(U64)
    anchor = (_sliding_least(value, width)[starts] & U64(_LOW)).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    tail = np.concatenate([head[1:], [len(starts)]]) - 1
    first, last = starts[head], starts[tail]
    return np.searchsorted(u.first, first, side="right") - 1, first, last, anchor[head]


def _batch(columns: dict[str, np.ndarray], n: int) -> pa.RecordBatch:
    kinds = {"kind": np.int32, "bucket": np.int32, "known": np.int32}
    full = {c: np.zeros(n, kinds.get(c, np.int64)) if c not in columns else np.asarray(columns[c]).astype(kinds.get(c, np.int64), copy=False) for c in _NAMES}
    return pa.RecordBatch.from_arrays([pa.array(full[c]) for c in _NAMES], _NAMES)


def combine(h, g, doc, mark, start, stop, known, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal (h, g): an order by group and place, the first row of each group, its size, and the rows to cut.

    The order is by h, g, doc, mark, start. Where the earliest stays, all later rows of a group go, but for repeats of
    the same place; else all rows of groups of two and more, or known to be repeated, go.
    """
    order = np.lexsort((start, mark, doc, g, h))
    H, G = h[order], g[order]
    new = np.concatenate([[True], (H[1:] != H[:-1]) | (G[1:] != G[:-1])]) if len(order) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    size = np.diff(np.concatenate([head, [len(order)]]))
    group = np.cumsum(new) - 1
    if spec.keep_first:
        lead = head[group]
        same = (doc[order] == doc[order][lead]) & (mark[order] == mark[order][lead]) & (start[order] == start[order][lead])
        cut = order[~same]
    else:
        repeated = (size > 1) | (np.maximum.reduceat(known[order], head) > 0 if len(head) else np.zeros(0, bool))
        cut = order[repeated[group]]
    return order, head, size, cut


def _mapped(spec: Spec, buckets: int):
    """Segments of each piece of input, equal ones combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", spec.slice_bytes):
                u = Units(batch.column("text"), spec)
                text, first, last, anchor = segments(u, spec)
                if not len(text):
                    continue
                doc, base = batch.column("doc").to_numpy()[text], u.first[text]
                h = mix(span_hash(u.one, anchor, anchor + spec.part))
                g = mix(span_hash(u.two, first, last + spec.length, 1) + mix((anchor - first).astype(U64)))
                rows = {"h": h.view(np.int64), "g": g.view(np.int64), "doc": doc, "mark": batch.column("mark").to_numpy()[text], "start": first - base, "stop": last + spec.length - base, "known": np.zeros(len(h), np.int64)}
                yield from _sent(rows, spec, buckets, LOCAL_HOT)

    return run


def _sent(rows: dict[str, np.ndarray], spec: Spec, buckets: int, hot_over: int | None) -> Iterator[pa.RecordBatch]:
    """What a piece of input sends on: cuts it can decide alone, and the first row of each group."""
    order, head, size, cut = combine(**rows, spec=spec)
    take = lambda at, **more: {k: v[at] for k, v in rows.items()} | more
    if len(cut):
        yield _batch(take(cut, kind=np.full(len(cut), CUT), bucket=rows["doc"][cut] % buckets), len(cut))
    firsts = order[head]
    known = np.zeros(len(firsts), np.int64) if spec.keep_first else np.maximum(size > 1, rows["known"][firsts]).astype(np.int64)
    h = rows["h"][firsts]
    hot = np.zeros(len(h), bool)
    if hot_over is not None:
        edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        many = np.diff(np.concatenate([edges, [len(h)]]))
        hot = np.repeat(many > hot_over, many)
        marks = h[edges[many > hot_over]]
        if len(marks):
            yield _batch({"kind": np.full(len(marks), MARK), "bucket": (marks.view(U64) % U64(buckets)), "h": marks}, len(marks))
    bucket = (h.view(U64) % U64(buckets)).astype(np.int64)
    if hot.any():
        at = firsts[hot]
        yield _batch(take(at, known=known[hot], kind=np.full(len(at), HOT), bucket=rows["doc"][at] % buckets), len(at))
    at = firsts[~hot]
    yield _batch(take(at, known=known[~hot], kind=np.full(len(at), SEGMENT), bucket=bucket[~hot]), len(at))


def _whole_groups(batches: Iterator[pa.RecordBatch], enough: Callable[[pa.Table], bool]) -> Iterator[pa.Table]:
    """Rows that come sorted by h, in tables of whole groups of one h; a table is passed on once it is `enough`.

    Memory holds such a table and one group, however many rows a partition has.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        h = batch.column("h").to_numpy()
        cut = int(np.searchsorted(h, h[-1]))  # where the last group, which may go on, begins
        if held and h[0] != held[-1].column("h")[-1].as_py() and enough(table := pa.Table.from_batches(held)):
            yield table
            held = []
        if cut:
            held.append(batch.slice(0, cut))
            if enough(table := pa.Table.from_batches(held)):
                yield table
                held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in _NAMES if c not in ("kind", "bucket")}


def _reduced(spec: Spec):
    """Cuts for equal segments, and the variants to compare: one row of each surrounding of an anchor that has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, lambda t: len(t) >= ROWS_AT_ONCE):
            kind = table.column("kind").to_numpy()
            decided = (kind == CUT) | (kind == HOT)
            if decided.any():
                yield from table.filter(pa.array(decided)).to_batches()
            marked = np.unique(table.column("h").to_numpy()[kind == MARK])
            rows = {c: x[kind == SEGMENT] for c, x in _columns(table).items()}
            if not len(rows["h"]):
                continue
            order, head, size, cut = combine(**rows, spec=spec)
            if len(cut):
                yield _batch({k: v[cut] for k, v in rows.items()} | {"kind": np.full(len(cut), CUT)}, len(cut))
            firsts = order[head]
            h = rows["h"][firsts]
            edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            many = np.repeat(np.diff(np.concatenate([edges, [len(h)]])), np.diff(np.concatenate([edges, [len(h)]])))
            hot = np.isin(h, marked) | (many > GROUP)
            at = np.flatnonzero((many > 1) | hot)
            if len(at):
                known = np.maximum(size[at] > 1, rows["known"][firsts[at]])
                yield _batch({k: v[firsts[at]] for k, v in rows.items()} | {"known": known, "kind": np.where(hot[at], HOT, ASK)}, len(at))

    return run


def _fetched(spec: Spec, buckets: int):
    """The texts of variants, dealt by anchor; of hot anchors the windows, dealt by their own hashes."""
    names = [*_NAMES, "piece"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", spec.slice_bytes):
                u = Units(batch.column("text"), spec)
                asked = batch.column("asked")
                items, edges = asked.flatten(), np.concatenate([[0], np.cumsum(asked.value_lengths().to_numpy())])
                text = np.repeat(np.arange(len(asked)), np.diff(edges))
                f = {c: items.field(c).to_numpy() for c in ("h", "start", "stop", "hot", "known")}
                doc, mark, base = batch.column("doc").to_numpy()[text], batch.column("mark").to_numpy(), u.first[text]
                hot = f["hot"] > 0
                if (~hot).any():
                    at = np.flatnonzero(~hot)
                    a, b = f["start"][at] + base[at], f["stop"][at] + base[at]
                    lo, hi = (u.starts[a], u.ends[b - 1]) if spec.unit == "word" else (a, b)
                    whole_bytes = u.buf.tobytes()
                    pieces = pa.array([whole_bytes[x:y] for x, y in zip(lo.tolist(), hi.tolist())], pa.binary())
                    h = f["h"][at]
                    out = _batch({"kind": np.full(len(at), ASK), "bucket": h.view(U64) % U64(buckets), "h": h, "doc": doc[at], "mark": mark[text[at]], "start": f["start"][at], "stop": f["stop"][at], "known": f["known"][at]}, len(at))
                    yield pa.RecordBatch.from_arrays([*out.columns, pieces], names)
                if hot.any():
                    at = np.flatnonzero(hot)
                    count = f["stop"][at] - f["start"][at] - spec.length + 1
                    of = np.repeat(at, count)
                    start = f["start"][of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                    one, two = u.hashes(start + base[of], start + base[of] + spec.length)
                    rows = {"h": one.view(np.int64), "g": two.view(np.int64), "doc": doc[of], "mark": mark[text[of]], "start": start, "stop": start + spec.length, "known": f["known"][of]}
                    for out in _sent(rows, spec, buckets, None):
                        yield pa.RecordBatch.from_arrays([*out.columns, pa.nulls(out.num_rows, pa.binary())], names)

    return run


def _compared(spec: Spec, compare: Callable[[pa.Table, Spec], tuple[np.ndarray, ...]]):
    """Cuts among variants, by the caller's method, and among the windows of hot anchors."""
    names = ["doc", "mark", "start", "stop"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, lambda t: len(t) >= ROWS_AT_ONCE or t.nbytes >= SHARD):
            has = table.column("piece").is_valid().to_numpy()
            cut = table.column("kind").to_numpy() == CUT
            if cut.any():
                yield from table.filter(pa.array(cut)).select(names).to_batches()
            rows = {c: x[~has & ~cut] for c, x in _columns(table).items()}
            if len(rows["h"]):
                gone = combine(**rows, spec=spec)[3]
                yield pa.RecordBatch.from_arrays([pa.array(rows[c][gone]) for c in names], names)
            if has.any():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in compare(table.filter(pa.array(has)), spec)], names)

    return run


def repeated_spans(docs: DataFrame, spec: Spec, compare: Callable[[pa.Table, Spec], tuple[np.ndarray, ...]]) -> DataFrame:
    """docs (doc_id, text) with `doc`, `mark` and `gone`, the list of (start, stop) unit ranges to remove (null: none).

    doc is the doc_id where that is a whole number, else a hash of it; mark is a hash of the text. compare gets the
    variants of some anchors, a table with h, doc, mark, start, known and piece, and returns doc, mark, start and stop
    of each window to cut.
    """
    buckets = partitions(docs.sparkSession)
    whole = dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")
    number = F.col("doc_id").cast("long") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    keyed = docs.select("doc_id", "text", F.coalesce(number, F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("mark"))
    dealt = lambda df: df.repartitionById(buckets, F.pmod("bucket", F.lit(buckets))).sortWithinPartitions("h")
    sent = keyed.select("doc", "mark", "text").mapInArrow(_mapped(spec, buckets), ROW)
    reduced = settle(dealt(sent).mapInArrow(_reduced(spec), ROW).select("kind", "h", "doc", "mark", "start", "stop", "known"))
    asks = reduced.filter(F.col("kind").isin(ASK, HOT)).select("doc", "mark", F.struct("h", "start", "stop", (F.col("kind") == HOT).cast("int").alias("hot"), "known").alias("ask"))
    asked = asks.groupBy("doc", "mark").agg(F.collect_list("ask").alias("asked"))
    fetched = keyed.join(asked, ["doc", "mark"]).select("doc", "mark", "text", "asked").mapInArrow(_fetched(spec, buckets), ROW + ", piece binary")
    compared = dealt(fetched).mapInArrow(_compared(spec, compare), "doc long, mark long, start long, stop long")
    cuts = reduced.filter(F.col("kind") == CUT).select("doc", "mark", "start", "stop").unionByName(compared)
    gone = cuts.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
    return keyed.join(gone, ["doc", "mark"], "left")


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching ranges joined, in order."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    head = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]])) if len(start) else np.zeros(0, np.int64)
    return start[head], stop[np.concatenate([head[1:], [len(start)]]) - 1] if len(start) else stop


def removed(joined: DataFrame, cut: Callable[[bytes, np.ndarray, np.ndarray], tuple[int, bytes]], kept: str) -> DataFrame:
    """doc_id, n_units, spans (merged ranges that went) and kept, what is left by `cut`, a column of type `kept`."""
    kind = dict(joined.dtypes)["doc_id"]
    shape = f"doc_id {kind}, n_units long, spans array<struct<start: long, stop: long>>, kept {kept}"
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                buf, offsets = text_bytes(batch.column("text"))
                lists, units, spans, left = batch.column("gone"), [], [], []
                inner, sizes = lists.flatten(), pa.compute.fill_null(lists.value_lengths(), 0).to_numpy()
                a, b = inner.field("start").to_numpy(), inner.field("stop").to_numpy()
                edges = np.concatenate([[0], np.cumsum(sizes)])
                for i in range(batch.num_rows):
                    x, y = merged(a[edges[i] : edges[i + 1]], b[edges[i] : edges[i + 1]])
                    n, rest = cut(buf[offsets[i] : offsets[i + 1]].tobytes(), x, y)
                    units.append(n)
                    spans.append([{"start": s, "stop": t} for s, t in zip(x.tolist(), y.tolist())])
                    left.append(rest)
                out = pa.array(left, pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(units, pa.int64()), pa.array(spans, span), out.cast(pa.string()) if kept == "string" else out], ["doc_id", "n_units", "spans", "kept"])

    return joined.select("doc_id", "text", "gone").mapInArrow(run, shape)
