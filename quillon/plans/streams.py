"""Queries over streams with state, and the admission cap in both forms: the batch rows from input that comes late and shuffled."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators import admission
from quillon.operators.storage import shared_path
from quillon.plans.ledger import events, micros
from quillon.registry import query
from quillon.streaming import stateful

HOUR = 3_600_000_000
#: Starts of a stream over one table, each with the days that follow.
STARTS = 4


@contextmanager
def partitions(spark: SparkSession, most: int):
    """At most so many partitions of shuffles and state inside: each costs a start of Python and a commit in every batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def in_batches(spark: SparkSession, rows: DataFrame, rule: Callable[..., DataFrame], name: str) -> DataFrame:
    """What a stream with a delay of one day gives for rows (ts, ...), which come in STARTS starts on one checkpoint.

    Every second row of the last half day of a start comes with the next one, in the order of a hash; a last row of the
    far future lets the watermark pass everything. Buckets and partitions of state follow from the number of rows.
    """
    path, state, out = (shared_path(spark, f"{name}-{kind}") for kind in ("in", "state", "out"))
    began, ended, many = rows.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
    if began is None:
        return spark.createDataFrame([], rule(rows.filter("false")).schema)
    step = (ended - began) / STARTS
    at = F.unix_micros("ts") - int(began.timestamp() * 1e6)
    width = max(1, int(step.total_seconds() * 1e6) + 1)
    due = F.floor(at / width)
    late = (at % width >= width - 12 * HOUR) & (F.xxhash64("id") % 2 == 0)
    dealt = rows.withColumn("start", due + late.cast("int"))
    far = rows.limit(1).withColumn("ts", F.lit("2200-01-01").cast("timestamp"))
    many = stateful.buckets(many)
    with partitions(spark, max(2, many // 8)):
        for k in range(STARTS + 2):
            part = dealt.filter(F.col("start") == k).drop("start") if k <= STARTS else far
            part.orderBy(F.xxhash64("id", F.lit(k))).write.mode("append").parquet(path)
            stream = rule(spark.readStream.schema(rows.schema).parquet(path), many=many)
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def told(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).withColumn("at", micros())


FOLD_SQL = """list_reduce(list_prepend([]::bigint[], list_transform(generate_series(1, len(ts)), lambda i: [i])),
  lambda a, x: case when len(a) >= {cap} and ts[a[len(a) - {cap} + 1]] >= ts[x[1]] - {span} then a else list_append(a, x[1]) end)"""


def fold_sql(key: str, cap: int, span: int) -> str:
    """The plain fold: of each key's events in order, the numbers of those that are let in."""
    return f"""select unnest(ids) as event_id, unnest(list_transform(generate_series(1, len(ids)), lambda i: list_contains(a, i))) as admitted
      from (select ids, {FOLD_SQL.format(cap=cap, span=span)} as a from (select list(epoch_us(ts) order by ts, event_id) as ts, list(event_id order by ts, event_id) as ids from events group by {key}))"""


@query("admission_cap", f"select o.event_id, o.admitted as overall, u.admitted as by_user from ({fold_sql('()', 10, HOUR)}) o join ({fold_sql('user_id', 2, 6 * HOUR)}) u using (event_id)")
def admission_cap(spark, sf):
    """At most 10 events in an hour, and 2 of a user in six, counting those that were let in."""
    rows = told(spark, sf).select("at", F.col("event_id").alias("id"), "user_id")
    overall = admission.admitted(rows.select(F.lit(0).alias("key"), "at", "id"), 10, HOUR)
    by_user = admission.admitted(rows.select(F.col("user_id").alias("key"), "at", "id"), 2, 6 * HOUR)
    both = overall.select("id", F.col("admitted").alias("overall")).join(by_user.select("id", F.col("admitted").alias("by_user")), "id")
    return both.withColumnRenamed("id", "event_id")


@query("admission_stream", fold_sql("user_id", 2, 6 * HOUR))
def admission_stream(spark, sf):
    rows = events(spark, sf).select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    return in_batches(spark, rows, partial(stateful.admitting, cap=2, span=6 * HOUR), "admission").select(F.col("id").alias("event_id"), "admitted")


@query(
    "confirm_stream",
    """with h as (select event_id, user_id, event_type, case when event_id % 5 > 0 then floor(value / 25)::bigint end as cur, ts from events),
    p as (select *, coalesce(list(coalesce(cur, -1)) over (partition by user_id, event_type order by ts, event_id rows between 6 preceding and 1 preceding), []) as past, coalesce(cur, -1) as now from h)
    select event_id, case when list_position(past, now) > 0 and len(list_filter(past[list_position(past, now) + 1:], lambda x: x <> now)) > 0 then 'oscillating'
      when len(past) > 0 and past[-1] = now and now >= 0 then 'confirmed' else 'unconfirmed' end as verdict from p""",
)
def confirm_stream(spark, sf):
    now = F.when(F.col("event_id") % 5 > 0, F.floor(F.col("value") / 25).cast("long"))
    rows = events(spark, sf).select(F.col("user_id").alias("key"), F.col("event_type").alias("field"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), now.alias("now"))
    return in_batches(spark, rows, stateful.confirmed, "confirm").select(F.col("id").alias("event_id"), "verdict")


@query(
    "reaped_stream",
    """with e as (select user_id as key, ts::date as day, ts, event_id, floor(value)::bigint as tokens, event_type = 'purchase' as ends from events),
    b as (select key, day, min(ts) as t from e group by all), o as (select e.*, b.t from e join b using (key, day) where e.ts <= b.t + interval 4 hours),
    f as (select key, day, min((ts, event_id)) as last from o where ends group by all)
    select o.key, o.day, case when any_value(f.last) is null then 'abandoned' else 'done' end as status, epoch_us(any_value(o.t)) as began, sum(o.tokens)::bigint as tokens
    from o left join f on o.key = f.key and o.day = f.day where f.last is null or (o.ts, o.event_id) <= f.last group by o.key, o.day""",
)
def reaped_stream(spark, sf):
    """The events of a user on a day as a run that a purchase ends."""
    rows = events(spark, sf).select(F.col("user_id").alias("key"), F.to_date("ts").alias("day"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.floor("value").cast("long").alias("tokens"), (F.col("event_type") == "purchase").alias("ends"))
    return in_batches(spark, rows, stateful.reaped, "reaped")
