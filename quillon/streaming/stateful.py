"""Streams whose rows are taken in order of event time, with state by key and timers at the watermark.

Rows wait until the watermark has passed them, when no earlier one can come any more; then the key's rule sees them in
order of (time, id). So the result does not depend on how batches cut or shuffle a stream, as long as nothing is later
than the watermark's delay; what is later is dropped by Spark.

Keys are dealt by hash into buckets, and a bucket is what Spark groups by: it keeps its waiting rows and the states of its
keys as one Arrow table each. A call and a few exchanges with the state store serve all keys of a bucket at once; they
cost about a millisecond, which is too much for each of millions of keys. A batch reads and writes what its buckets hold.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quillon.operators.admission import fold

KINDS = {"long": pa.int64(), "boolean": pa.bool_(), "longs": pa.list_(pa.int64())}
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Buckets of a stream whose size is not told. The number belongs to a checkpoint: it must be the same at each start.
BUCKETS = 256
#: Rows that a bucket should take in all, and that are given out at once.
SHARE, GIVEN = 20_000, 50_000


def buckets(rows: int) -> int:
    """Into how many buckets the keys of a stream of so many rows are dealt."""
    return max(16, -(-rows // SHARE))


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(held: bytes) -> pa.Table:
    return pa.ipc.open_stream(held).read_all()


def tuples(table: pa.Table, columns: list[str]) -> list[tuple]:
    return list(zip(*(table.column(c).to_pylist() for c in columns)))


class InOrder(StatefulProcessor):
    """Rows of each key of a bucket in order of `at` (microseconds) and `id`; `waiting` are the columns of a row that wait
    with these two, `kept` those of a key's state.

    A rule implements `load` and `save` (a key's state as a tuple, None for none), `take` (one row: the rows it gives, as
    tuples), `wake` (when it wants to be asked again though no row comes, in microseconds) and `due` (what it gives then).
    """

    waiting: list[tuple[str, str]] = []
    kept: list[tuple[str, str]] = []
    output: list[str] = []

    def keyed(self, keys: list[tuple[str, pa.DataType]]) -> InOrder:
        self.keys = [k for k, _ in keys]
        shaped = lambda columns: pa.schema([*keys, *((c, KINDS[t]) for c, t in columns)])
        self.held, self.states = shaped([("at", "long"), ("id", "long"), *self.waiting]), shaped(self.kept)
        return self

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getValueState("rows", "held binary, wake long")  # wake: the earliest of the states
        self.own = handle.getValueState("states", "held binary")

    def load(self, state: tuple | None) -> None:
        raise NotImplementedError(type(self))

    def save(self) -> tuple | None:
        raise NotImplementedError(type(self))

    def take(self, row: tuple) -> list[tuple]:
        raise NotImplementedError(type(self))

    def wake(self) -> int | None:
        return None

    def due(self, until: int) -> list[tuple]:
        return []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [pa.Table.from_pandas(part[self.held.names], self.held, preserve_index=False) for part in rows]
        yield from self._advance(new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance([], timerValues)

    def _advance(self, new: list[pa.Table], timerValues) -> Iterator[pd.DataFrame]:
        until = 1000 * timerValues.getCurrentWatermarkInMs()
        waited, wake = self.rows.get() if self.rows.exists() else (None, None)
        held = pa.concat_tables([*([unpacked(waited)] if waited else []), *new]) if waited or new else self.held.empty_table()
        if held["at"].null_count:
            raise ValueError("a row without a time has no place in the order")
        passed = pc.less_equal(held["at"], until)
        ready, rest = held.filter(passed), held.filter(pc.invert(passed))
        out: list[tuple] = []
        if len(ready) or (wake is not None and wake <= until):
            out, wake = self._passed(ready, until)
        if len(rest) or wake is not None:
            self.rows.update((packed(rest) if len(rest) else None, wake))
        else:
            self.rows.clear()
        wakes = [t for t in (pc.min(rest["at"]).as_py(), wake) if t is not None]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if wakes:
            self.handle.registerTimer(min(wakes) // 1000 + 1)
        for a in range(0, len(out), GIVEN):
            yield pd.DataFrame(out[a : a + GIVEN], columns=self.output).astype(object)

    def _passed(self, ready: pa.Table, until: int) -> tuple[list[tuple], int | None]:
        """What the rules of all keys give when the watermark has passed some rows, and when the first wants to be asked again."""
        before = unpacked(self.own.get()[0]) if self.own.exists() else self.states.empty_table()
        states = dict(zip(tuples(before, self.keys), tuples(before, [c for c, _ in self.kept])))
        ready = ready.sort_by([(c, "ascending") for c in (*self.keys, "at", "id")])
        out: list[tuple] = []
        lines = zip(tuples(ready, self.keys), tuples(ready, self.held.names[len(self.keys) :]))
        for key, line in groupby(lines, key=itemgetter(0)):
            self.load(states.get(key))
            for _, row in line:
                out += ((*key, *r) for r in (*self.due(row[0] - 1), *self.take(row)))
            states[key] = self.save()
        wakes, left = [], []
        for key, state in states.items():
            if state is not None:
                self.load(state)
                out += ((*key, *r) for r in self.due(until))
                state, wake = self.save(), self.wake()
                if wake is not None:
                    wakes.append(wake)
            if state is not None:
                left.append((*key, *state))
        if left:
            self.own.update((packed(pa.table([pa.array(c, t) for c, t in zip(zip(*left), self.states.types)], self.states)),))
        else:
            self.own.clear()
        return out, min(wakes, default=None)

    def close(self) -> None: ...


class Confirming(InOrder):
    """Verdict on each value of a field against the six before it: the rule of ledger.oscillation."""

    waiting, kept, output = [("now", "long")], [("seen", "longs")], ["key", "field", "id", "verdict"]
    depth = 6

    def load(self, state):
        self.past = deque(state[0] if state else (), maxlen=self.depth)

    def save(self):
        return (list(self.past),)

    def take(self, row):
        (_, id_, now), past = row, list(self.past)
        here = past.index(now) if now in past else None
        if here is not None and any(v != now for v in past[here + 1 :]):
            verdict = "oscillating"
        elif past and now is not None and past[-1] == now:
            verdict = "confirmed"
        else:
            verdict = "unconfirmed"
        self.past.append(now)
        return [(id_, verdict)]


class Admitting(InOrder):
    """Whether each event of a key is let in: the rule of admission.admitted, with a queue of times as state."""

    kept, output = [("times", "longs")], ["key", "id", "admitted"]

    def __init__(self, cap: int, span: int):
        self.cap, self.span = cap, span

    def load(self, state):
        self.let = deque(state[0] if state else (), maxlen=self.cap)

    def save(self):
        return (list(self.let),) if self.let else None

    def take(self, row):
        return [(row[1], fold([row[0]], self.let, self.cap, self.span)[0])]

    def wake(self):
        return self.let[-1] + self.span + 1 if self.let else None

    def due(self, until):
        while self.let and self.let[0] < until - self.span:  # can refuse nothing any more
            self.let.popleft()
        return []


class Reaping(InOrder):
    """Runs that end or are abandoned: (key, day) begins with its first row; a row with `ends` closes it, and so does the
    time `limit` after its beginning. Given are the status and the totals until then. After `keep` the state is gone."""

    waiting, kept = [("tokens", "long"), ("ends", "boolean")], [("began", "long"), ("tokens", "long"), ("open", "boolean")]
    output = ["key", "day", "status", "began", "tokens"]

    def __init__(self, limit: int, keep: int):
        self.limit, self.keep = limit, keep

    def load(self, state):
        self.now = state

    def save(self):
        return self.now

    def take(self, row):
        at, _, more, ends = row
        if self.now is None:
            self.now = (at, 0, True)
        began, tokens, open_ = self.now
        if not open_:
            return []
        self.now = (began, tokens + (more or 0), not ends)
        return [("done", *self.now[:2])] if ends else []

    def wake(self):
        return None if self.now is None else self.now[0] + (self.limit if self.now[2] else self.keep)

    def due(self, until):
        out = []
        if self.now is not None and self.now[2] and self.now[0] + self.limit <= until:
            out.append(("abandoned", *self.now[:2]))
            self.now = (*self.now[:2], False)
        if self.now is not None and not self.now[2] and self.now[0] + self.keep <= until:
            self.now = None
        return out


def _stateful(rows: DataFrame, keys: list[str], rule: InOrder, shape: str, delay: str, many: int) -> DataFrame:
    """rows with a timestamp `ts` beside at = its microseconds, their keys dealt into `many` buckets."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rule.keyed([(k, to_arrow_type(rows.schema[k].dataType)) for k in keys])
    bucket = F.pmod(F.xxhash64(*keys), F.lit(many)).alias("bucket")
    timed = rows.withWatermark("ts", delay).select(bucket, "ts", *keys, F.unix_micros("ts").alias("at"), "id", *(c for c, _ in rule.waiting))
    return timed.groupBy("bucket").transformWithStateInPandas(rule, shape, "Append", "EventTime")


def confirmed(values: DataFrame, delay: str = "1 day", many: int = BUCKETS) -> DataFrame:
    """(key, field, id, verdict) for values (key, field, id, ts, now), as ledger.oscillation gives over ledger.history."""
    return _stateful(values, ["key", "field"], Confirming(), "key long, field string, id long, verdict string", delay, many)


def admitting(events: DataFrame, cap: int, span: int, delay: str = "1 day", many: int = BUCKETS) -> DataFrame:
    """(key, id, admitted) for events (key, id, ts), as admission.admitted gives; span in microseconds."""
    return _stateful(events, ["key"], Admitting(cap, span), "key long, id long, admitted boolean", delay, many)


def reaped(rows: DataFrame, limit: int = 4 * 3_600_000_000, keep: int = 86_400_000_000, delay: str = "1 day", many: int = BUCKETS) -> DataFrame:
    """(key, day, status, began, tokens) for rows (key, day, id, ts, tokens, ends): runs that are done, or abandoned after `limit`."""
    return _stateful(rows, ["key", "day"], Reaping(limit, keep), "key long, day date, status string, began long, tokens long", delay, many)
