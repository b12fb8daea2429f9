"""Replay of conversations with quarantine and cascading release: a fixed point over the turns' parents.

Turns are put in order of conversation and number by a range partitioning that also cuts conversations, so that no
conversation, however long, is one task's. In each part deliveries begin as if no turn had a parent; a vectorised
relaxation then recomputes only turns whose parent's delivery changed, until nothing does. A turn that is never delivered
is delivered at infinity, which is how death reaches its descendants. What descends from a turn of another part stays open,
and only that is recomputed, part by part, when a delivery at the end of the part before turns out otherwise. Release
numbers and states are prefix sums, by parts again. No join here is left to a broadcast, as each side grows with the turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import discard, match, partitions, settle

#: When what is dead or blocked is delivered.
NEVER = 1 << 62
#: Contents of a turn that the relaxation passes through.
TURN = ["conv_id", "turn", "part", "at", "back", "wait", "passes", "weight"]
PLACE = ["start", "p", "tail"]
FOUND = ["outside", "open", "given", "first_at", "last_at", "attempts", "until"]


def chance(k: int) -> Column:
    """crc32 of `k:conv_id:turn` in decimal; a null conv_id or turn is empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.crc32(F.concat(F.lit(f"{k}:"), text("conv_id"), F.lit(":"), text("turn")))


def _ordered(rows: DataFrame, *by: Column) -> DataFrame:
    """rows with `part` and `at`, their place in the order `by`: parts follow each other, and so do rows in a part.

    The last key is the row's place in the input, so that a part ends where it is full, among equal rows too.
    """
    n = partitions(rows.sparkSession)
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    sorted_ = tied.repartitionByRange(n, *by, "tie").sortWithinPartitions(*by, "tie").drop("tie")
    return settle(sorted_.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))


def _number(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[dict]:
    """Columns of the turns with their numbers, from turns and, before the first of each conversation in a part, a mark."""
    last = None
    for batch in batches:
        mark = batch.column("mark").to_numpy(zero_copy_only=False)
        turns, marks = batch.filter(pa.array(~mark)), batch.filter(pa.array(mark))
        of = np.cumsum(mark)[~mark]  # 0: the last mark of the batch before
        facts = np.stack([marks.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "before", "n", "several")], axis=1)
        facts = np.concatenate([np.zeros((1, 4), np.int64) if last is None else last[None, :], facts])
        last = facts[-1]
        start, before, n, several = facts[of].T
        nth = turns.column("at").to_numpy() - start
        yield {c: turns.column(c) for c in TURN} | {"start": start, "p": nth + before, "tail": several.astype(bool) & (nth >= n - reach)}


def relax(reach: int, gap: int, delay: int, most: int):
    """Deliveries of turns in order; a turn whose parent is not in the part takes `given`, or at first no parent."""
    offsets = delay * ((1 << np.arange(most, dtype=np.int64)) - 1)
    bits = 1 << np.arange(most)

    def tried(begin: np.ndarray, repaired: np.ndarray, passes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last attempt and the delivery, of turns whose first attempt is at `begin`."""
        good = (begin[:, None] + offsets >= repaired[:, None]) & (passes[:, None] & bits > 0)
        done = good.any(axis=1) & (begin < NEVER)
        nth = np.where(done, good.argmax(axis=1), most - 1)
        return nth, np.where(done, begin + offsets[nth], NEVER)

    def run(batches: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        held = {c: np.zeros(0, np.int64) for c in ("part", "start", "p", "until", "open")}
        for batch in batches:
            col = lambda c: np.asarray(batch[c]).astype(np.int64)
            part, start, p, back, passes = (col(c) for c in ("part", "start", "p", "back", "passes"))
            if not len(p):
                continue
            given = batch["given"].to_numpy(zero_copy_only=False) if "given" in batch else np.full(len(p), np.nan)
            given = np.where(np.isnan(given), 0, given).astype(np.int64)
            k = len(held["p"])
            all_ = {"part": np.concatenate([held["part"], part]), "start": np.concatenate([held["start"], start]), "p": np.concatenate([held["p"], p])}
            i = np.arange(len(p)) + k
            parent = np.full(len(p), -1)
            has = (back > 0) & (p >= back)
            for step in range(1, reach + 1):
                j = np.maximum(i - step, 0)
                same = (i >= step) & (all_["part"][j] == part) & (all_["start"][j] == start) & (all_["p"][j] == p - back)
                parent = np.where(has & same, j, parent)
            outside = has & (parent < 0)
            arrival, repaired = gap * p, gap * p + col("wait")
            begin = np.where(outside, np.maximum(arrival, given), arrival)
            nth, own = tried(begin, repaired, passes)
            until, open_ = np.concatenate([held["until"], own]), np.concatenate([held["open"], outside.astype(np.int64)])
            changed = np.ones(len(until), dtype=bool)
            while len(todo := np.flatnonzero((parent >= 0) & changed[parent])):
                begin[todo] = np.maximum(arrival[todo], until[parent[todo]])
                nth[todo], new = tried(begin[todo], repaired[todo], passes[todo])
                opened = open_[parent[todo]]
                moved = (new != until[k + todo]) | (opened != open_[k + todo])
                until[k + todo], open_[k + todo] = new, opened
                changed = np.zeros(len(until), dtype=bool)
                changed[k + todo[moved]] = True
            never = begin >= NEVER
            arrays = [*(batch[c] for c in TURN), pa.array(start), pa.array(p), pa.array(np.asarray(batch["tail"]).astype(bool)), pa.array(outside), pa.array(open_[k:] > 0), pa.array(given)]
            arrays += [pa.array(begin, mask=never), pa.array(np.where(never, 0, begin + offsets[nth]), mask=never), pa.array(np.where(never, 0, nth + 1).astype(np.int32)), pa.array(until[k:])]
            yield pa.RecordBatch.from_arrays(arrays, [*TURN, *PLACE, *FOUND])
            all_ |= {"until": until, "open": open_}
            held = {c: v[-reach:] for c, v in all_.items()}

    return run


def replay(turns: DataFrame, gap: int = 7, reach: int = 4, delay: int = 20, most: int = 6) -> DataFrame:
    """conv_id, turn, status, attempts, first_at, last_at, release_no, state for each row of turns (conv_id, turn, text).

    The turns of a conversation, numbered p from 0, arrive at second gap * p. The parent of a turn stands chance(0) modulo
    reach + 1 turns before it. Of the turns with chance(1) % 101 < 50 attempts fail until chance(2) % 101 seconds after
    arrival, and attempt a if chance(a + 2) % 3 is 0. Attempt 1 is at arrival or the parent's delivery, whichever is later;
    attempt a + 1 comes delay * 2**(a - 1) seconds after attempt a. After `most` failures a turn is dead; its descendants
    are blocked. release_no and state (the sum of release_no * crc32 of the text so far, as a 64-bit number that wraps
    around) follow last_at, then the turn.

    Turns are numbered by turn, null last, equal ones by crc32 of their texts, so that rows that repeat are turns of
    their own. A null conv_id is one conversation, whose name in chance() is empty. A null text counts as an empty one.
    Other columns are ignored. An empty table gives no rows.
    """
    spark = turns.sparkSession
    faulty = chance(1) % 101 < 50
    bits = sum((F.when(chance(a + 2) % 3 != 0, F.lit(1 << (a - 1))).otherwise(0) for a in range(1, most + 1)), F.lit(0))
    plain = turns.select(
        "conv_id", "turn", (chance(0) % (reach + 1)).cast("int").alias("back"), F.when(faulty, chance(2) % 101).otherwise(0).cast("int").alias("wait"),
        F.when(faulty, bits).otherwise((1 << most) - 1).cast("int").alias("passes"), F.crc32(F.coalesce("text", F.lit(""))).alias("weight"),
    )
    held = _ordered(plain, F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("weight"))
    within = Window.partitionBy("conv_id").orderBy("part")
    marks = held.groupBy("conv_id", "part").agg(F.min("at").alias("at"), F.count("*").alias("n"))
    marks = marks.select(
        "conv_id", "part", "at", F.lit(True).alias("mark"), F.col("at").alias("start"), "n", (F.sum("n").over(within) - F.col("n")).alias("before"),
        (F.count("*").over(Window.partitionBy("conv_id")) > 1).cast("long").alias("several"),
    )
    both = held.withColumn("mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    many = partitions(spark)
    by_part = lambda rows, *more: rows.repartitionById(many, "part").sortWithinPartitions("part", "at", *more)
    kinds = dict(held.dtypes)
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in TURN) + ", start long, p long, tail boolean, outside boolean, open boolean, given long, first_at long, last_at long, attempts int, until long"
    step = relax(reach, gap, delay, most)
    columns = lambda batches: ({c: b.column(c) for c in b.schema.names} for b in batches)
    state = settle(by_part(both, F.col("mark").desc()).mapInArrow(lambda batches: step(_number(batches, reach)), shape))
    discard(held)
    settled, open_ = state.filter(~F.col("open")), state.filter("open")
    held = None
    while True:
        ends = settled.filter("tail").unionByName(open_.filter("tail")).select("conv_id", "p", F.col("until").alias("now"))
        asked = open_.filter("outside").select("conv_id", (F.col("p") - F.col("back")).alias("p"), "part", "at", "start", "given")
        moved = settle(match(asked.hint("merge"), ends, ["conv_id", "p"]).filter("now <> given").select("part", "at", "start", "now"))
        if moved.isEmpty():
            break
        groups = moved.select("part", "start").distinct()
        told = open_.hint("merge").join(groups, ["part", "start"], "left_semi").hint("merge").join(moved.drop("start"), ["part", "at"], "left").withColumn("given", F.coalesce("now", "given")).drop("now")
        again = by_part(told).mapInArrow(lambda batches: step(columns(batches)), shape)
        after = settle(open_.hint("merge").join(groups, ["part", "start"], "left_anti").unionByName(again))
        if held is not None:
            discard(held)
        discard(moved)
        held = open_ = after
    return _released(settled.unionByName(open_))


def _released(rows: DataFrame) -> DataFrame:
    """Number the delivered turns of each conversation and sum up their states, by prefix sums over parts."""
    status = F.when(F.col("until") < NEVER, "delivered").when(F.col("attempts") > 0, "dead").otherwise("blocked")
    shown = rows.select("conv_id", "turn", status.alias("status"), "attempts", "first_at", "last_at", "p", "weight")
    held = _ordered(shown.filter("status = 'delivered'"), F.col("conv_id").asc_nulls_first(), F.col("last_at"), F.col("turn").asc_nulls_last(), F.col("p"))
    # In a part, with k = 1, 2, ... there: the sums of weights and of k * weight, exact; the turns before add their number to each k.
    big = "decimal(38,0)"
    own = Window.partitionBy("conv_id", "part").orderBy("at")
    k = held.withColumn("k", F.row_number().over(own).cast("long"))
    summed = k.withColumn("w", F.sum("weight").over(own)).withColumn("kw", F.sum(F.col("k").cast("decimal(19,0)") * F.col("weight").cast("decimal(10,0)")).over(own).cast(big))
    spans = k.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.sum("weight").alias("all_w"), F.sum(F.col("k").cast("decimal(19,0)") * F.col("weight").cast("decimal(10,0)")).cast(big).alias("all_kw"))
    order = Window.partitionBy("conv_id").orderBy("part")
    placed = spans.withColumn("before", F.sum("n").over(order) - F.col("n"))
    through = (F.col("before").cast("decimal(18,0)") * F.col("all_w").cast("decimal(19,0)")).cast(big) + F.col("all_kw")
    placed = placed.withColumn("own", through.cast(big)).withColumn("base", (F.sum("own").over(order) - F.col("own")).cast(big)).select("conv_id", "part", "before", "base")
    total = (F.col("base") + (F.col("before").cast("decimal(18,0)") * F.col("w").cast("decimal(19,0)")).cast(big) + F.col("kw")).cast(big)
    wrapped = (F.pmod(total + F.lit(Decimal(2**63)).cast(big), F.lit(Decimal(2**64)).cast(big)) - F.lit(Decimal(2**63)).cast(big)).cast("long")
    told = match(summed.hint("merge"), placed, ["conv_id", "part"]).select("conv_id", "turn", "status", "attempts", "first_at", "last_at", (F.col("before") + F.col("k")).alias("release_no"), wrapped.alias("state"))
    rest = shown.filter("status <> 'delivered'").select("conv_id", "turn", "status", "attempts", "first_at", "last_at", F.lit(None).cast("long").alias("release_no"), F.lit(None).cast("long").alias("state"))
    return told.unionByName(rest)
