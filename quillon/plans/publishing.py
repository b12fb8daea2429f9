"""Queries of publication: checks, exports, the dump of the ledger, the cycle with its gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillon.operators import publishing
from quillon.operators.serving import GRADES
from quillon.operators.storage import settled, shared_path
from quillon.plans.records import FIRMS_SQL, GRADE_SQL, reachable, table
from quillon.plans.serving import SIGNALS_SQL, signals
from quillon.registry import query

# Each state of a record that a check looks for occurs for some record numbers.
STATED_SQL = f"""x as (select crd, name, domain, state, release_state, final_category as category, person_status, release_basis, {GRADE_SQL} as grade, case when crd % 4 < 2 then 'P' || crd || '@example.com' end as email, case when crd % 9 = 0 then 's' || crd || '@example.com' end as secondary_email,
  case when crd % 3 = 0 then 'Ann' end as contact_name, case when crd % 8 > 0 then 'rule' end as release_basis_detail, case when crd % 10 = 0 then 'flagged' when crd % 10 < 9 then 'current' end as trust_state, case when crd % 20 > 0 then 'site dark' end as trust_reason,
  case when crd % 6 > 0 then '2026-01-31' end as data_asof, (crd * 13) % 100 as completion, case when crd % 2 = 0 then ['energy', 'real estate'] else [] end as sectors from records),
contacts as (select c_custkey as crd from customer where c_custkey % 6 = 0), audit as (select 'p' || c_custkey || '@EXAMPLE.com' as email from customer where c_custkey % 12 = 0 union all select 's' || c_custkey || '@example.com' from customer where c_custkey % 18 = 0)"""


def stated(spark, sf):
    k, text = F.col("crd"), F.col("crd").cast("string")
    return reachable(spark, sf).select(
        "crd", "name", "domain", "state", "release_state", F.col("final_category").alias("category"), "person_status", "release_basis", "grade",
        F.when(k % 4 < 2, F.concat(F.lit("P"), text, F.lit("@example.com"))).alias("email"), F.when(k % 9 == 0, F.concat(F.lit("s"), text, F.lit("@example.com"))).alias("secondary_email"), F.when(k % 3 == 0, "Ann").alias("contact_name"),
        F.when(k % 8 > 0, "rule").alias("release_basis_detail"), F.when(k % 10 == 0, "flagged").when(k % 10 < 9, "current").alias("trust_state"), F.when(k % 20 > 0, "site dark").alias("trust_reason"), F.when(k % 6 > 0, "2026-01-31").alias("data_asof"),
        (k * 13 % 100).alias("completion"), F.when(k % 2 == 0, F.array(F.lit("energy"), F.lit("real estate"))).otherwise(F.array().cast("array<string>")).alias("sectors"),
    )


def contacts(spark, sf):
    return table(spark, sf, "customer").filter("c_custkey % 6 = 0").select(F.col("c_custkey").alias("crd"), F.lit("primary").alias("role"))


def audit(spark, sf):
    customers = table(spark, sf, "customer")
    one = customers.filter("c_custkey % 12 = 0").select(F.concat(F.lit("p"), F.col("c_custkey").cast("string"), F.lit("@EXAMPLE.com")).alias("email"))
    return one.union(customers.filter("c_custkey % 18 = 0").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string"), F.lit("@example.com"))))


LEAK_SQL = "exists (select 1 from audit a where lower(a.email) in (lower(x.email), lower(x.secondary_email)))"


@query("leaked_addresses", f"with {FIRMS_SQL}, {STATED_SQL} select crd from x where release_state = 'qualifying' and {LEAK_SQL}")
def leaked_addresses(spark, sf):
    return publishing.leaked(stated(spark, sf), audit(spark, sf))


_Q = "release_state = 'qualifying'"
_TESTS = {
    "proven decision-makers are ratified": f"{_Q} and person_status = 'proven' and not ratified",
    "no unratified contact ships": f"{_Q} and (contact_name is not null or email is not null) and not ratified",
    "person_status is in the vocabulary": f"{_Q} and not coalesce(person_status in ('proven', 'not_established'), false)",
    "entity-only records present nobody": f"{_Q} and person_status = 'not_established' and (contact_name is not null or email is not null)",
    "gate-released records carry their evidence": f"{_Q} and release_basis = 'gate_released' and coalesce(release_basis_detail, '') = ''",
    "qualifying records state a basis": f"{_Q} and release_basis is null",
    "qualifying records carry a trust state": f"{_Q} and trust_state is null",
    "flagged records state a reason": "trust_state = 'flagged' and coalesce(trust_reason, '') = ''",
    "qualifying records carry a date": f"{_Q} and data_asof is null",
    "no rejected address on a qualifying record": f"{_Q} and {LEAK_SQL}",
    "no rejected grade on a qualifying record": f"{_Q} and grade in ('D', 'F') and coalesce(email, '') <> ''",
}
_COUNTS = " union all ".join(f"select '{n}' as \"check\", count(*) filter (where {t}) as found, count(*) filter (where {t}) = 0 as ok from x" for n, t in _TESTS.items())


@query(
    "reconcile_records",
    f"with {FIRMS_SQL}, {STATED_SQL.replace('x as (select crd', 'y as (select crd')}, x as (select *, crd in (select crd from contacts) as ratified from y) {_COUNTS} union all select 'some qualifying offices exist', count(*), count(*) > 0 from x where {_Q} and category in ('single_family_office', 'multi_family_office')",
)
def reconcile_records(spark, sf):
    return publishing.record_checks(stated(spark, sf), contacts(spark, sf), audit(spark, sf))


_OFFICES, _COUNTED = "('single_family_office', 'multi_family_office')", "('single_family_office', 'multi_family_office', 'embedded_fo_practice')"
_SURFACE = f"""case when release_state = 'quarantined' then 'quarantined' when release_state = 'qualifying' then case when category = 'embedded_fo_practice' then 'practices' else 'family_offices' end
  when category is null then 'awaiting_adjudication' when category in {_COUNTED} then 'pending_decision_maker' else 'reclassified' end"""


def _shipped(spark, sf):
    rows = settled(stated(spark, sf), "records")
    paths = publishing.export(rows, signals(spark, sf), shared_path(spark, "export"))
    return {n: publishing.read_surface(spark, paths[n], columns) for n, (_, columns, _) in publishing.surfaces(rows).items()}


_GRADES = "[" + ", ".join(f"'{g}'" for g in GRADES[:3]) + "]"


@query(
    "export_surfaces",
    f"""with {FIRMS_SQL}, {STATED_SQL}, {SIGNALS_SQL}, g as (select crd, count(*) || ' signal(s); latest ' || max(date || ' (' || type || '): ' || description) as summary from s group by 1),
    e as (select *, {_SURFACE} as surface from x), f as (select *, surface in ('family_offices', 'practices') as product, coalesce(list_position({_GRADES}, grade) - 1, 6) as place from e)
    select surface, row_number() over (partition by surface order by case when product then place end, case when product then completion end desc, case when not product and surface <> 'quarantined' then category end nulls first, name, crd) as nth,
      crd::varchar as crd, case when product then coalesce(summary, 'no recent signal found') end as signals, case when product and len(sectors) > 0 then array_to_string(sectors, '; ') end as sectors
    from f left join g using (crd)""",
)
def export_surfaces(spark, sf):
    """Writes the surfaces and returns what a reader of the files finds, line by line: the files' names are in order, and so are their lines."""
    out, rows = None, _shipped(spark, sf)
    line = Window.partitionBy("surface").orderBy("file", "line")
    for name, df in rows.items():
        more = {"signals": "Recent Signals", "sectors": "Investing Sectors"}
        shown = [(F.col(f"`{h}`") if h in df.columns else F.lit(None).cast("string")).alias(c) for c, h in more.items()]
        part = df.select(F.lit(name).alias("surface"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"), F.col("CRD").alias("crd"), *shown)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("nth", F.row_number().over(line)).drop("file", "line")


_CHECKED = {f"{n} as shipped are those held": "0" for n in publishing.SURFACES.values()} | {
    "the surfaces partition all held records": "0",
    "qualifying records are the offices and practices": f"abs(count(*) filter (where {_Q}) - count(*) filter (where surface in ('family_offices', 'practices')))",
    "the product has offices only": f"count(*) filter (where surface = 'family_offices' and not coalesce(category in {_OFFICES}, false))",
    "no rejected address was shipped": "count(*) filter (where surface = 'family_offices' and bad)",
    "no rejected grade was shipped": "count(*) filter (where surface = 'family_offices' and grade in ('D', 'F') and coalesce(email, '') <> '')",
    "reclassified firms are no offices": f"count(*) filter (where surface = 'reclassified' and category in {_COUNTED})",
    "quarantined firms cannot be retrieved": "count(*) filter (where surface = 'quarantined' and found)",
    "reclassified firms cannot be retrieved": "count(*) filter (where surface = 'reclassified' and found)",
    "qualifying offices can be retrieved": f"count(*) filter (where {_Q} and category in {_OFFICES} and not found)",
}


@query(
    "reconcile_surfaces",
    f"""with {FIRMS_SQL}, {STATED_SQL}, e as (select *, {_SURFACE} as surface, crd % 7 > 0 as found, exists (select 1 from audit a where lower(a.email) = lower(x.email)) as bad from x)
    select t as "check", f as found, f = 0 as ok from (select unnest([{", ".join(f"'{n}'" for n in _CHECKED)}]) as t, unnest([{", ".join(_CHECKED.values())}]) as f from e)""",
)
def reconcile_surfaces(spark, sf):
    index = table(spark, sf, "customer").filter("c_custkey % 7 > 0").select(F.col("c_custkey").alias("crd"))
    return publishing.surface_checks(stated(spark, sf), _shipped(spark, sf), audit(spark, sf), index)


@query("trust_of_real_runs", "select event_id, run_id from (select event_id, user_id as run_id from events) where run_id in (select o_custkey from orders where o_orderkey % 3 = 0) and run_id % 2 = 0")
def trust_of_real_runs(spark, sf):
    k = F.col("run_id")
    runs = table(spark, sf, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("run_id")).distinct()
    config = F.when(k % 4 == 1, '{"workers": 3}').when(k % 2 == 0, '{"write": true}').otherwise('{"write": false}')
    events = table(spark, sf, "events").select("event_id", F.col("user_id").alias("run_id"))
    return publishing.trust_of_real_runs(events, runs.withColumn("config", config)).select("event_id", "run_id")


@query("ledger_dump", "select 'events' as \"table\", count(*) as rows, 'events' as folder from events union all select 'orders', count(*), 'orders' from orders union all select 'runs', 0, 'runs'")
def ledger_dump(spark, sf):
    tables = {"events": table(spark, sf, "events"), "orders": table(spark, sf, "orders"), "runs": table(spark, sf, "orders").limit(0)}
    return publishing.dump(tables, {"events": ["event_id"], "orders": ["o_orderkey"], "runs": ["o_orderkey"]}, shared_path(spark, "dump"))


@query(
    "cycle_ledger",
    """select 7::bigint as run_id, seq::int as seq, phase, status, detail from (values (0, 'observe', 'ok', '3'), (1, 'resolve', 'ok', '2'), (2, 'promote', 'ok', '1'), (3, 'rebuild', 'error', 'ReleaseStopped: checks before publication failed: second'), (4, 'close', 'failed', '4 phases')) t(seq, phase, status, detail)""",
)
def cycle_ledger(spark, sf):
    """Phases in their order, whatever the order they are given in; a failing check stops what is published after it."""
    checks = lambda *ok: spark.createDataFrame([("first", ok[0]), ("second", ok[1])], "check string, ok boolean")
    published = []
    rebuild = lambda: publishing.gated_release(lambda: checks(True, False), lambda: published.append(1), lambda: checks(True, True))
    ledger = publishing.run_cycle(spark, {"rebuild": rebuild, "promote": lambda: 1, "observe": lambda: 3, "resolve": lambda: 2}, 7)
    if published:
        raise AssertionError("nothing is published after a failed check")
    return ledger
