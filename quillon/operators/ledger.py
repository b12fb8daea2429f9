"""Operators over the ledger of observations: changes, oscillation, trust, admission, budgets, claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.rules import reach_class
from quillon.operators.keyed import first_rows, latest, top


def observed_changes(observations: DataFrame) -> DataFrame:
    """What each observation (key, at, id, status, content) says about its key, against the ones before.

    A failure of a host that was reachable, or a second transient error in a row, is dark; reachable again after a flag
    is recovered; a throttled fetch says nothing. Content is compared with the last known only where none of these holds.
    """
    seen = Window.partitionBy("key").orderBy("at", "id")
    before = seen.rowsBetween(Window.unboundedPreceding, -1)
    now, prior = F.col("class"), F.lag("class").over(seen)
    dark = ((now == "unreachable") & (prior == "reachable")) | ((now == "transient") & (prior == "transient"))
    classed = observations.withColumn("class", reach_class(F.col("status"))).withColumn("dark", F.coalesce(dark, F.lit(False)))
    mark = F.when(F.col("dark"), True).when(now == "reachable", False)
    flagged = F.coalesce(F.last(mark, ignorenulls=True).over(before), F.lit(False))
    known = F.last("content", ignorenulls=True).over(before)
    change = (
        F.when(now == "throttled", "throttled")
        .when(F.col("dark"), "dark")
        .when((now == "reachable") & F.col("flagged"), "recovered")
        .when(F.col("known") != F.col("content"), "changed")
        .when(F.col("known").isNull() & F.col("content").isNotNull(), "baselined")
        .otherwise("none")
    )
    return classed.withColumn("flagged", flagged).withColumn("known", known).select("id", "key", "class", change.alias("change"))


def history(value: Column, keys: list[str], *order: Column, n: int = 6) -> Column:
    """The n values before a row's own, oldest first, null ones included: structs with the one field v."""
    return F.collect_list(F.struct(value.alias("v"))).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-n, -1))


def oscillation(past: Column, now: Column) -> Column:
    """oscillating: seen before and displaced since; confirmed: the same as the last, if that is known; else unconfirmed."""
    count = F.size(past)
    here = F.array_position(F.transform(past, lambda x: x["v"].eqNullSafe(now)), F.lit(True)).cast("int")
    back = (here > 0) & F.exists(F.slice(past, here + 1, count), lambda x: ~x["v"].eqNullSafe(now))
    same = F.try_element_at(past, F.lit(-1))["v"] == now
    return F.when(back, "oscillating").when(same, "confirmed").otherwise("unconfirmed")


def trust_state(events: DataFrame) -> DataFrame:
    """State of each key from its newest event (key, check, at, id, flagged) of each check; reason: the newest two flagged checks."""
    newest = latest(events, ["key", "check"], F.desc("at"), F.desc("id"))
    two = first_rows(newest.filter("flagged"), ["key"], 2, F.desc("at"), F.desc("id"))
    reason = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("#n", "check"))), lambda x: x["check"]), "; ")
    reasons = two.groupBy("key").agg(reason.alias("reason"))
    states = newest.groupBy("key").agg(F.when(F.bool_or("flagged"), "flagged").otherwise("current").alias("state"), F.count("*").alias("checks"))
    return states.join(reasons, "key", "left")


def rolling_count(events: DataFrame, span: int) -> DataFrame:
    """Rows (id, at in microseconds) with how many rows lie in the span that ends with them.

    Each row is given to its own stretch of time and to the next, so that a stretch holds all it has to count and no
    task sees the whole line of time.
    """
    own = F.floor(F.col("at") / span)
    dealt = events.withColumn("own", own).withColumn("stretch", F.explode(F.array(own, own + 1)))
    counted = dealt.withColumn("recent", F.count("*").over(Window.partitionBy("stretch").orderBy("at").rangeBetween(-span, 0)))
    return counted.filter("stretch = own").drop("own", "stretch")


def fair_order(items: DataFrame, share: float = 0.30, least: int = 25) -> DataFrame:
    """Items (key, last) that fit the budget, the longest unseen first, never seen before all."""
    budget = items.agg(F.greatest(F.lit(least), F.ceil(F.lit(share) * F.count("*"))).alias("n")).scalar()
    order = [F.asc_nulls_first("last"), F.asc("key")]
    # Counted by day first: days that fit go whole, and only rows of the day in which the budget ends are ranked.
    day = F.coalesce(F.floor(F.col("last") / 86_400_000_000), F.lit(-(2**62)))
    sums = items.groupBy(day.alias("#day")).agg(F.count("*").alias("#own"))
    ahead = sums.withColumn("#ahead", F.coalesce(F.sum("#own").over(Window.orderBy("#day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = items.withColumn("#day", day).join(ahead.filter(F.col("#ahead") < budget), "#day")
    whole = placed.filter(F.col("#ahead") + F.col("#own") <= budget)
    edge = placed.filter(F.col("#ahead") + F.col("#own") > budget).withColumn("#place", F.col("#ahead") + F.row_number().over(Window.partitionBy("#day").orderBy(*order)))
    return whole.select(*items.columns).unionByName(edge.filter(F.col("#place") <= budget).select(*items.columns))


def claim(queue: DataFrame, n: int, retries: int = 3) -> DataFrame:
    """The next n rows (key, status, attempts) to work on: new ones before failed ones, none that failed too often."""
    open_ = queue.filter(F.col("status").isin("pending", "in_progress") | ((F.col("status") == "failed") & (F.col("attempts") < retries)))
    return top(open_, n, (F.col("status") == "failed").asc(), F.asc("key"))


def cost_rollup(runs: DataFrame, run_events: DataFrame, stale_before: str) -> DataFrame:
    """Tokens and cost of each run, 0 where it has no events; runs that have been running too long are abandoned."""
    sums = run_events.groupBy("run_id").agg(F.sum("tokens").alias("tokens"), F.sum("micros").alias("micros"))
    status = F.when((F.col("status") == "running") & (F.col("started_at") < F.lit(stale_before).cast("timestamp_ntz")), "abandoned").otherwise(F.col("status"))
    return runs.join(sums, "run_id", "left").select("run_id", status.alias("status"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), F.coalesce("micros", F.lit(0)).cast("long").alias("micros"))
