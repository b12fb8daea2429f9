"""Queries of answers. Customers stand in for answers, each over a few records by number."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.operators import answers
from quillon.plans.records import cases, table
from quillon.registry import query

# What answers say, by answer number, and over which record.
SAID = [
    "Write to A{k}@example.org. There are 3 firms.", "Reach bad{k}@example.org, a total of 12 records.", "Firm {k}, LLC is the family office to call.",
    "firm {k} llc is a wealth manager that calls itself a family office; found 3.", "Try x@example.com!", None,
]


def _filled(k, pairs):
    """Each text with the number put in, by the number's remainder."""
    from quillon.plans.records import cases as by_case

    put = lambda t: F.replace(F.lit(t), F.lit("{k}"), k.cast("string"))
    return by_case(k % len(pairs), [(i, put(t)) for i, t in enumerate(pairs) if t is not None])


def said(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.alias("id"), _filled(k, SAID).alias("text"), F.when(k % 4 > 0, 3).alias("total"))


def hits(spark, sf):
    k = F.col("c_custkey")
    address = lambda head: F.concat(F.lit(head), k.cast("string"), F.lit("@example.org"))
    return table(spark, sf, "customer").select(k.alias("id"), k.alias("crd"), F.concat(F.lit("Firm "), k.cast("string"), F.lit(", LLC")).alias("name"), F.when(k % 5 > 0, "wealth_manager").otherwise("multi_family_office").alias("category"), address("a").alias("email"), F.when(k % 9 == 1, address("BAD")).alias("secondary_email"))


def audit(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").filter("c_custkey % 2 = 1").select(k.alias("crd"), F.concat(F.lit("Bad"), k.cast("string"), F.lit("@example.org")).alias("email"))


GROUND_SQL = """c as (select c_custkey as id, c_custkey % 6 as m, case when c_custkey % 4 > 0 then 3 end as total from customer),
f as (select id, 'email not on a record' as "check", 'bad' || id || '@example.org' as detail, true as blocks from c where m = 1 and id % 9 <> 1
  union all select id, 'email not on a record', 'x@example.com', true from c where m = 4 union all select id, 'rejected address', 'bad' || id || '@example.org', true from c where m = 1 and id % 2 = 1
  union all select id, 'count is not the total', '12', false from c where m = 1 and total is not null union all select id, 'called an office', 'Firm ' || id || ', LLC', true from c where m = 2 and id % 5 > 0)"""


@query("grounding_failures", f"with {GROUND_SQL} select * from f")
def grounding_failures(spark, sf):
    return answers.grounding_failures(said(spark, sf), hits(spark, sf), audit(spark, sf))


@query("grounding_verdicts", f"with {GROUND_SQL} select c.id, count(*) filter (where blocks) = 0 as ok, count(*) filter (where blocks) as failures, count(*) filter (where not blocks) as warnings from c left join f using (id) group by 1")
def grounding_verdicts(spark, sf):
    rows = said(spark, sf)
    return answers.verdicts(rows, answers.grounding_failures(rows, hits(spark, sf), audit(spark, sf)))


@query(
    "routed_queries",
    """with q as (select c_custkey as id, c_custkey % 3 as i, c_custkey % 2 = 0 as filtered, case when c_custkey % 7 < 6 then (c_custkey % 10) / 10.0 end as nearest, c_custkey % 5 < 2 as own from customer),
    o as (select *, nearest is null or nearest > 0.64 as out, i = 2 and filtered and not own as fb from q)
    select id, case when out then 'out_of_scope' when i = 0 then 'lookup' when i = 1 then 'aggregate' else 'discovery' end as route, case when out then [] when fb then [id + 5] when own then [id + 1, id] else [] end as ids, case when not out and fb then 'no record passed the filters; these are nearest only' end as note from o""",
)
def routed_queries(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer")
    queries = rows.select(k.alias("id"), cases(k % 3, [(0, "lookup"), (1, "aggregate")], "unknown").alias("intent"), (k % 2 == 0).alias("filtered"), F.when(k % 7 < 6, (k % 10) / 10.0).alias("nearest"))
    strict = rows.filter("c_custkey % 5 < 2").select(k.alias("id"), F.explode(F.array(F.struct(k.alias("hit"), F.lit(2).alias("rank")), F.struct((k + 1).alias("hit"), F.lit(1).alias("rank")))).alias("h")).select("id", "h.hit", "h.rank")
    return answers.routed(queries, strict, rows.select(k.alias("id"), (k + 5).alias("hit"), F.lit(1).alias("rank")))


@query(
    "composed_answers",
    f"""select c_custkey as id, case c_custkey % 3 when 0 then 'fine' when 1 then 'mended' else '{answers.REFUSED}' end as text, case c_custkey % 3 when 0 then 'released' when 1 then 'repaired' else 'refused' end as outcome from customer""",
)
def composed_answers(spark, sf):
    k = F.col("id")
    compose = lambda q: q.select("id", F.when(k % 3 == 0, "fine").when((k % 3 == 1) & F.array_contains("repair", "bad word"), "mended").otherwise("bad").alias("text"))
    check = lambda a: a.filter("text = 'bad'").select("id", F.lit("bad word").alias("detail"))
    return answers.composed(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), compose, check)


BODIES = [
    '{"verdict": "Two fit.", "picks": [{"firm": "A", "fit_summary": "s", "confidence": "strong", "evidence": ["e"]}], "limitations": ["l"]}', '{"picks": [{"firm": "", "fit_summary": "s", "confidence": "sure", "evidence": []}]}', "no json",
    '{"verdict": "v", "watchlist": [{"firm": "W", "what_changed": "gone", "recommendation": "panic"}], "coverage_note": "c"}',
]


@query(
    "submitted_answers",
    """select c_custkey as id, case c_custkey % 4 when 0 then [] when 1 then ['verdict', 'pick without firm or reason', 'confidence', 'pick without evidence'] when 2 then ['verdict'] else ['watchlist'] end as problems,
    case c_custkey % 4 when 0 then 'Two fit.   l ' when 1 then '   ' when 2 then '   ' else 'v c    gone' end as prose from customer""",
)
def submitted_answers(spark, sf):
    body = cases(F.col("c_custkey") % 4, list(enumerate(BODIES)))
    a, problems = answers.parsed_answer(body)
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), problems.alias("problems"), answers.free_text(a).alias("prose"))


@query(
    "goal_gate",
    """with g as (select c_custkey as goal from customer) select goal, 'recommends what is not released' as failure, 'Hidden Partners' as detail from g where goal % 2 = 0 union all select goal, 'address not on a record', 'b@x.org' from g where goal % 2 = 1
    union all select goal, 'pick is no record', 'Nobody' from g where goal % 3 = 0 union all select goal, 'pick is not releasable', 'beta ' from g where goal % 3 = 1
    union all select goal, 'watched firm is no record', 'Nobody' from g where goal % 4 = 0 union all select goal, 'watched firm was never released', 'Beta' from g where goal % 4 = 1
    union all select goal, 'place is neither met nor mentioned', 'BOSTON' from g where goal % 5 = 0 and goal % 2 = 1""",
)
def goal_gate(spark, sf):
    goal = table(spark, sf, "customer").select(F.col("c_custkey").alias("goal"))
    k = F.col("goal")
    prose = F.when(k % 2 == 0, "We suggest Hidden Partners. Nothing in Boston; write a@x.org.").otherwise("Hidden Partners is on file. Write to A@x.org or b@x.org.")
    firms = lambda *by: cases(by[0], [(i, F.array(F.lit(f))) for i, f in enumerate(by[1:])], F.array(F.lit(" ALPHA")))
    goals = goal.select("goal", prose.alias("prose"), firms(k % 3, "Nobody", "beta ").alias("picks"), firms(k % 4, "Nobody", "Beta").alias("watch"))
    mails = F.array(F.lit("A@X.org"))
    held = F.explode(F.array(F.struct(F.lit("Alpha").alias("name"), F.lit(True).alias("pickable"), F.lit("Troy").alias("city"), mails.alias("emails")), F.struct(F.lit("Beta").alias("name"), F.lit(False).alias("pickable"), F.lit("Rome").alias("city"), mails.alias("emails")))).alias("r")
    places = goal.filter("goal % 5 = 0").withColumn("place", F.lit("Boston"))
    return answers.goal_failures(goals, goal.select("goal", held).select("goal", "r.*"), goal.withColumn("name", F.lit("Hidden Partners")), places)


@query("grounding_merge", "select coalesce(a.k, b.k) as crd, coalesce(b.name, a.name) as name, a.city, b.tier from (select c_custkey as k, c_name as name, 'Troy' as city from customer where c_custkey % 3 > 0) a full join (select c_custkey as k, case when c_custkey % 4 > 0 then 'N' || c_custkey end as name, 'weak' as tier from customer where c_custkey % 2 = 0) b on a.k = b.k")
def grounding_merge(spark, sf):
    k, rows = F.col("c_custkey"), table(spark, sf, "customer")
    old = rows.filter("c_custkey % 3 > 0").select(k.alias("crd"), F.col("c_name").alias("name"), F.lit("Troy").alias("city"))
    new = rows.filter("c_custkey % 2 = 0").select(k.alias("crd"), F.when(k % 4 > 0, F.concat(F.lit("N"), k.cast("string"))).alias("name"), F.lit("weak").alias("tier"))
    return answers.merged_grounding(old, new)


@query("tool_loop", "select * from (values (0, 'search', 'ok'), (1, 'search', 'repeated'), (2, 'broken', 'error: KeyError'), (3, 'search', 'ok'), (4, 'submit', 'ok')) t(step, tool, status)")
def tool_loop(spark, sf):
    """A scripted planner in the place of a model."""
    script = [{"tool": "search", "args": {"n": 1}}, {"tool": "search", "args": {"n": 1}}, {"tool": "broken"}, {"tool": "search", "args": {"n": 2}}, {"tool": "submit", "args": {"verdict": "done"}}]
    _, log = answers.run_tools(lambda seen: script[len(seen)], {"search": lambda args: args["n"]})
    return spark.createDataFrame([(e["step"], e["tool"], e["status"]) for e in log], "step int, tool string, status string")
