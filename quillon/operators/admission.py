"""A cap on admitted events in a rolling span: a sequential fold that runs in parallel.

Whether an event is admitted depends on those admitted before it, back to the first. The line of events is cut into parts
that are folded at once, each as if nothing had been admitted before; what a part ends with is then given to the next, and
parts that were given something else than they were folded with are folded again. As a fold forgets what is older than
the span, ends soon agree, and the result is the sequential one whenever nothing changes any more.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators.storage import shared_path


def fold(times: list[int], held: deque, cap: int, span: int) -> list[bool]:
    """Which of some ascending times are admitted: fewer than cap (at least 1) admitted ones lie in the span before. held: the last cap admitted."""
    out = []
    for t in times:
        free = len(held) < cap or held[0] < t - span
        out.append(free)
        if free:
            held.append(t)  # of cap times the oldest goes
    return out


def _folds(cap: int, span: int, given: dict[int, list[int]], columns: list[str] | None):
    """Parts in order of (part, pos), the first key of each beginning with what is given: their rows (columns) with
    `admitted`, or (None) of each part only (part, first, last, state): its keys at both ends and what the last has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, held, ends, kind = None, None, deque(maxlen=cap), [], None
        for batch in batches:
            if not len(batch):
                continue
            parts, times, pos = (batch.column(c).to_numpy() for c in ("part", "at", "pos"))
            codes, kind = batch.column("key").dictionary_encode().indices.fill_null(-1).to_numpy(), batch.schema.field("key").type
            cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(parts) != 0)) + 1).tolist(), len(batch)]
            let: list[bool] = []
            for a, b in zip(cuts, cuts[1:]):
                own = batch.column("key")[a].as_py()
                if parts[a] != part or not same(own, key):
                    if parts[a] != part:
                        ends.append([int(parts[a]), own, None, None])
                    part, key, held = parts[a], own, deque(given.get(int(parts[a]), ()) if pos[a] == 0 else (), maxlen=cap)
                let += fold(times[a:b].tolist(), held, cap, span)
                ends[-1][2:] = own, list(held)
            if columns is not None:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(let)], [*columns, "admitted"])
        if columns is None and ends:
            one, first, last, state = zip(*ends)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int32()), pa.array(first, kind), pa.array(last, kind), pa.array(state, pa.list_(pa.int64()))], ["part", "first", "last", "state"])

    return run


def same(a, b) -> bool:
    """Whether two keys are one; null is a key, and so is NaN."""
    return a == b or (a != a and b != b)


def admitted(events: DataFrame, cap: int, span: int, share: int = 500_000) -> DataFrame:
    """events (key, at, id) with the column admitted: in order of (at, id) an event of a key is let in where fewer than
    cap of those let in lie within `span` before it (at - span included).

    `at` is a whole number in the unit of span; an event without a time is not let in. A null key is a key. Events that are
    equal in all three are taken one after the other. cap is 1 or more. Parts are of about `share` events, so that there
    are few to wait for one another; what they end with (cap numbers each) is all that the driver sees.
    """
    if cap < 1:
        raise ValueError("a cap of at least 1")
    spark, most = events.sparkSession, int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    timed = events.filter("at is not null").withColumn("at", F.col("at").cast("long"))
    many = max(1, min(most, -(-timed.count() // share)))
    order = ["key", "at", "id", "tie"]
    line = timed.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(many, *order).sortWithinPartitions(*order).drop("tie")
    rows = line.withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    path = shared_path(spark, "admission")
    rows.write.partitionBy("part").parquet(path)
    held = spark.read.schema(rows.schema).parquet(path)

    def folded(some: DataFrame, columns: list[str] | None, shape: str) -> DataFrame:
        return some.repartitionById(many, "part").sortWithinPartitions("part", "pos").mapInArrow(_folds(cap, span, dict(given), columns), shape)

    kind = dict(events.dtypes)["key"]
    given: dict[int, list[int]] = {}
    ends: dict[int, tuple] = {}
    again = list(range(many))
    while again:
        some = held.filter(F.col("part").isin(again)).select("part", "pos", "key", "at")
        ends |= {r["part"]: r for r in folded(some, None, f"part int, first {kind}, last {kind}, state array<long>").collect()}
        ordered, again = [ends[k] for k in sorted(ends)], []
        for before, this in zip(ordered, ordered[1:]):
            now = before["state"] if same(before["last"], this["first"]) else []
            if now != given.get(this["part"], []):
                given[this["part"]] = now
                if same(this["first"], this["last"]):  # otherwise what it ends with has begun in it
                    again.append(this["part"])
    shape = ", ".join(f"`{c}` {t}" for c, t in timed.select(*events.columns).dtypes) + ", admitted boolean"
    done = folded(held, events.columns, shape)
    untimed = events.filter("at is null").withColumn("admitted", F.lit(False)).withColumn("at", F.lit(None).cast("long"))
    return done.select(*events.columns, "admitted").unionByName(untimed)
