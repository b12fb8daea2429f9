"""The admission cap against a plain fold, and streams with state: order, restarts, late rows, timers, what state is left."""

import datetime as dt
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from quillon.operators import admission, ledger
from quillon.plans import streams
from quillon.streaming import stateful


def plain(rows, cap, span):
    out, held = [], {}
    for key, at, i in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        let = held.setdefault(key, [])
        ok = sum(t >= at - span for t in let) < cap
        let += [at] * ok
        out.append((key, at, i, ok))
    return sorted(out + [(k, None, i, False) for k, at, i in rows if at is None], key=repr)


@pytest.mark.parametrize(("cap", "span", "step"), [(1, 0, 3), (1, 50, 3), (4, 40, 1), (20, 300, 2), (3, 10**6, 5)])
def test_admission_equals_the_plain_fold(spark, monkeypatch, cap, span, step):
    g, at, rows = random.Random(cap), 0, []
    for i in range(700):
        at += g.choice([0, 0, step, step, 3 * step, 40 * step if g.random() < 0.02 else 0])
        rows.append((7, at, i))
    rows += [(g.choice([1, 2, 3, None]), g.randint(0, 90), 1000 + i) for i in range(200)] + [(1, None, 5000), (1, 5, 1000), (1, 5, 1000)]
    events = spark.createDataFrame(rows, "key long, at long, id long").repartition(5).withColumn("extra", F.lit("kept"))
    got = admission.admitted(events, cap, span)
    assert got.columns == ["key", "at", "id", "extra", "admitted"]
    assert sorted((tuple(r) for r in got.drop("extra").collect()), key=repr) == plain(rows, cap, span)


def test_admission_of_nothing(spark):
    assert admission.admitted(spark.createDataFrame([], "key string, at long, id long"), 3, 10).count() == 0
    with pytest.raises(ValueError):
        admission.admitted(spark.createDataFrame([], "key string, at long, id long"), 0, 10)
    assert admission.fold([1, 2, 3, 14], deque(maxlen=2), 2, 10) == [True, True, False, True]


T = dt.datetime(2024, 1, 1)


def series(seed, n=160):
    g = random.Random(seed)
    return [(g.randint(1, 3), g.choice("ab"), i, T + dt.timedelta(minutes=g.randint(0, 12_000)), g.choice([None, 1, 1, 2, 3])) for i in range(n)]


def test_confirming_equals_the_batch_rule(spark):
    values = spark.createDataFrame(series(2), "key long, field string, id long, ts timestamp, now long")
    got = {r.id: r.verdict for r in streams.in_batches(spark, values, stateful.confirmed, "confirm").collect()}
    past = values.withColumn("past", ledger.history(F.col("now"), ["key", "field"], F.col("ts"), F.col("id")))
    assert got == {r.id: r.v for r in past.select("id", ledger.oscillation(F.col("past"), F.col("now")).alias("v")).collect()}
    assert set(got.values()) == {"confirmed", "unconfirmed", "oscillating"}


def test_runs_end_or_are_abandoned_and_leave_no_state(spark, tmp_path):
    hour = lambda h: T + dt.timedelta(hours=h)
    rows = [(1, 0, 5, False), (1, 1, 7, True), (1, 2, 100, False), (2, 0, 1, False), (2, 3.5, 2, False), (2, 4.5, 50, True), (3, 6, None, True), (4, 7, 3, False), (4, 11, 4, False)]
    frame = spark.createDataFrame([(k, T.date(), i, hour(h), tokens, ends) for i, (k, h, tokens, ends) in enumerate(rows)], "key long, day date, id long, ts timestamp, tokens long, ends boolean")
    far = frame.limit(1).withColumns({"ts": F.lit("2200-01-01").cast("timestamp"), "key": F.lit(-1)})
    for part in (frame.filter("id % 2 = 0"), frame.filter("id % 2 = 1"), far):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stateful.reaped(spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in"))
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    at = lambda h: int(hour(h).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    got = sorted((r.key, r.status, r.began, r.tokens) for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect())
    assert got == [(1, "done", at(0), 12), (2, "abandoned", at(0), 3), (3, "done", at(6), 0), (4, "abandoned", at(7), 7)]
    left = query.lastProgress["stateOperators"][0]
    assert left["numRowsTotal"] <= 3  # the row of the far future, its place in the list, and its timer


def test_late_rows_are_dropped(spark, tmp_path):
    frame = spark.createDataFrame([(1, i, T + dt.timedelta(days=d)) for i, d in enumerate((0, 5, 10, 0.5, 12))], "key long, id long, ts timestamp")
    for ids in ("id <= 2", "id = 3", "id = 4"):
        frame.filter(ids).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stateful.admitting(spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in"), 5, 1000)
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    assert {r.id for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()} == {0, 1, 2}
