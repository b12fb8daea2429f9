"""Queries over the ledger of events and the costs of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators import keyed, ledger
from quillon.registry import query
from quillon.streaming import observe

STATUS_SQL = "case event_type when 'error' then 'transient' when 'click' then 'reachable' when 'view' then 'reachable' when 'signup' then 'throttled' else 'unreachable' end"


def micros() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def status() -> Column:
    """The test table's event types read as outcomes of fetches."""
    kind = F.col("event_type")
    return F.when(kind == "error", "error:timeout").when(kind == "click", "200").when(kind == "view", "202").when(kind == "signup", "429").otherwise("404")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def observations(rows: DataFrame) -> DataFrame:
    content = F.when(F.col("event_type").isin("click", "view"), F.floor("value").cast("long"))
    return rows.select(F.col("event_id").alias("id"), F.col("user_id").alias("key"), micros().alias("at"), status().alias("status"), content.alias("content"))


@query(
    "latest_per_key",
    "select distinct on (user_id, event_type) user_id, event_type, event_id, epoch_us(ts) as at from events order by user_id, event_type, ts desc, event_id desc",
)
def latest_per_key(spark, sf):
    return keyed.latest(events(spark, sf), ["user_id", "event_type"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_type", "event_id", micros().alias("at"))


@query(
    "latest_by_source_priority",
    """select o_custkey, o_orderkey, o_orderpriority from (
      select *, row_number() over (partition by o_custkey order by case when o_orderpriority like '1%' then 0 when o_orderpriority like '2%' then 1 else 2 end, o_orderkey desc) as n from orders) where n = 1""",
)
def latest_by_source_priority(spark, sf):
    first = F.when(F.col("o_orderpriority").startswith("1"), 0).when(F.col("o_orderpriority").startswith("2"), 1).otherwise(2)
    return keyed.latest(spark.read.parquet(f"{sf}/orders.parquet"), ["o_custkey"], first, F.desc("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    "trust_state",
    """with e as (select user_id as key, event_type as check_type, ts, event_id, value > 60 as flagged from events where (props->>'$.k')::int % 2 = 0),
    n as (select distinct on (key, check_type) * from e order by key, check_type, ts desc, event_id desc),
    r as (select key, string_agg(check_type, '; ' order by k) as reason from (select key, check_type, row_number() over (partition by key order by ts desc, event_id desc) as k from n where flagged) where k <= 2 group by key)
    select n.key, case when bool_or(flagged) then 'flagged' else 'current' end as state, count(*) as checks, any_value(r.reason) as reason
    from n left join r on n.key = r.key group by n.key""",
)
def trust_state(spark, sf):
    real = events(spark, sf).filter(F.get_json_object("props", "$.k").cast("int") % 2 == 0)
    return ledger.trust_state(real.select(F.col("user_id").alias("key"), F.col("event_type").alias("check"), F.col("ts").alias("at"), F.col("event_id").alias("id"), (F.col("value") > 60).alias("flagged")))


OBSERVE_SQL = f"""with o as (select event_id as id, user_id as key, ts, {STATUS_SQL} as class, case when event_type in ('click', 'view') then floor(value)::bigint end as content from events),
p as (select *, lag(class) over w as prior, last_value(content ignore nulls) over (partition by key order by ts, id rows between unbounded preceding and 1 preceding) as known from o window w as (partition by key order by ts, id)),
d as (select *, coalesce((class = 'unreachable' and prior = 'reachable') or (class = 'transient' and prior = 'transient'), false) as dark from p),
f as (select *, coalesce(last_value(case when dark then true when class = 'reachable' then false end ignore nulls) over (partition by key order by ts, id rows between unbounded preceding and 1 preceding), false) as flagged from d)
select id, key, class, case when class = 'throttled' then 'throttled' when dark then 'dark' when class = 'reachable' and flagged then 'recovered'
  when known <> content then 'changed' when known is null and content is not null then 'baselined' else 'none' end as change from f"""


@query("observe_changes", OBSERVE_SQL)
def observe_changes(spark, sf):
    return ledger.observed_changes(observations(events(spark, sf)))


@query("observe_stream_equiv", OBSERVE_SQL)
def observe_stream_equiv(spark, sf):
    schema = events(spark, sf).schema
    files = spark.read.format("binaryFile").option("pathGlobFilter", "events.parquet").load(sf).select("path")
    one_file = not files.isEmpty()  # the table is one file or a folder of files
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet" if one_file else "*.parquet").parquet(sf if one_file else f"{sf}/events.parquet")
    return observe.run_to_table(spark, observe.stream_changes(observations(stream)), "observe")


@query(
    "oscillation_confirm",
    """with h as (select event_id, user_id, event_type, case when event_id % 5 > 0 then floor(value / 25)::bigint end as cur, ts from events),
    p as (select *, coalesce(list(coalesce(cur, -1)) over (partition by user_id, event_type order by ts, event_id rows between 6 preceding and 1 preceding), []) as past, coalesce(cur, -1) as now from h)
    select event_id, case when list_position(past, now) > 0 and len(list_filter(past[list_position(past, now) + 1:], lambda x: x <> now)) > 0 then 'oscillating'
      when len(past) > 0 and past[-1] = now and now >= 0 then 'confirmed' else 'unconfirmed' end as verdict from p""",
)
def oscillation_confirm(spark, sf):
    now = F.when(F.col("event_id") % 5 > 0, F.floor(F.col("value") / 25).cast("long"))
    past = events(spark, sf).withColumn("now", now).withColumn("past", ledger.history(F.col("now"), ["user_id", "event_type"], F.col("ts"), F.col("event_id")))
    return past.select("event_id", ledger.oscillation(F.col("past"), F.col("now")).alias("verdict"))


@query(
    "run_cost_rollup",
    """select o.o_orderkey as run_id, case when o_orderstatus = 'P' and o_orderdate < timestamp '1998-01-01' then 'abandoned' when o_orderstatus = 'P' then 'running' else 'done' end as status,
      coalesce(s.tokens, 0)::bigint as tokens, coalesce(s.micros, 0)::bigint as micros
    from orders o left join (select l_orderkey, sum(l_quantity::bigint) as tokens, sum(l_quantity::bigint * case when l_returnflag = 'A' then 15 else 3 end) as micros from lineitem group by 1) s on o.o_orderkey = s.l_orderkey""",
)
def run_cost_rollup(spark, sf):
    tokens = F.col("l_quantity").cast("long")
    price = F.when(F.col("l_returnflag") == "A", 15).otherwise(3)
    used = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("run_id"), tokens.alias("tokens"), (tokens * price).alias("micros"))
    runs = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") == "P", "running").otherwise("done").alias("status"), F.col("o_orderdate").alias("started_at"))
    return ledger.cost_rollup(runs, used, "1998-01-01 00:00:00")


@query(
    "rolling_admission",
    "select event_id, count(*) over (order by ts range between interval 1 hour preceding and current row) as recent, count(*) over (order by ts range between interval 1 hour preceding and current row) <= 20 as admitted from events",
)
def rolling_admission(spark, sf):
    counted = ledger.rolling_count(events(spark, sf).select("event_id", micros().alias("at")), 3_600_000_000)
    return counted.select("event_id", "recent", (F.col("recent") <= 20).alias("admitted"))


@query(
    "fair_budget",
    """with u as (select user_id as key, max(case when event_type = 'purchase' then epoch_us(ts) end) as last from events group by 1)
    select key, last from u order by last nulls first, key limit (select greatest(25, ceil(0.30::double * count(*)))::int from u)""",
)
def fair_budget(spark, sf):
    seen = events(spark, sf).groupBy(F.col("user_id").alias("key")).agg(F.max(F.when(F.col("event_type") == "purchase", micros())).alias("last"))
    return ledger.fair_order(seen)


QUEUE_SQL = """with n as (select distinct on (user_id) user_id, event_type from events order by user_id, ts desc, event_id desc),
a as (select user_id, count(*) filter (where event_type = 'error') as attempts from events group by 1)
select n.user_id as key, case n.event_type when 'error' then 'failed' when 'purchase' then 'done' when 'click' then 'in_progress' else 'pending' end as status, a.attempts % 5 as attempts from n join a using (user_id)"""


@query("queue_claim", f"with q as ({QUEUE_SQL}) select * from q where status in ('pending', 'in_progress') or (status = 'failed' and attempts < 3) order by (status = 'failed'), key limit 50")
def queue_claim(spark, sf):
    rows = events(spark, sf)
    newest = keyed.latest(rows, ["user_id"], F.desc("ts"), F.desc("event_id"))
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "click", "in_progress").otherwise("pending")
    tried = rows.groupBy("user_id").agg((F.count_if(F.col("event_type") == "error") % 5).alias("attempts"))
    return ledger.claim(newest.join(tried, "user_id").select(F.col("user_id").alias("key"), status.alias("status"), "attempts"), 50)


@query("observation_coverage", "select event_type as kind, count(*) as n, count(distinct user_id) as keys, min(epoch_us(ts)) as first_at, max(epoch_us(ts)) as last_at from events group by 1")
def observation_coverage(spark, sf):
    return events(spark, sf).groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("keys"), F.min(micros()).alias("first_at"), F.max(micros()).alias("last_at"))


@query(
    "ledger_window",
    """select min(epoch_us(o_orderdate)) as first_at, max(epoch_us(coalesce(l.shipped, o_orderdate))) as last_at, count(*) as runs from orders left join (select l_orderkey, max(l_shipdate) as shipped from lineitem group by 1) l on o_orderkey = l_orderkey""",
)
def ledger_window(spark, sf):
    shipped = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    runs = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderdate").join(shipped, "o_orderkey", "left")
    at = lambda c: F.unix_micros(c.cast("timestamp"))
    return runs.agg(F.min(at(F.col("o_orderdate"))).alias("first_at"), F.max(at(F.coalesce("shipped", "o_orderdate"))).alias("last_at"), F.count("*").alias("runs"))


@query("run_mix", "select o_orderpriority as trigger, o_orderstatus as status, count(*) as n from orders group by 1, 2")
def run_mix(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.col("o_orderpriority").alias("trigger"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query(
    "record_history",
    """select user_id as key, event_type as kind, count(*) as n, list(event_id order by ts desc, event_id desc)[1:3] as newest from events where value > 50 group by 1, 2""",
)
def record_history(spark, sf):
    newest = F.slice(F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id")), asc=False), lambda x: x["event_id"]), 1, 3)
    return events(spark, sf).filter("value > 50").groupBy(F.col("user_id").alias("key"), F.col("event_type").alias("kind")).agg(F.count("*").alias("n"), newest.alias("newest"))
