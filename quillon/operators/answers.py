"""Answers: what their records allow them to say, routing, compose and repair, the gate over a goal's answer, the tool loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import emails_in, fold
from quillon.operators.retrieval import FLOOR, count_claims
from quillon.operators.review import recommends

# Labels of what is no office of its own, the loose pattern of addresses in prose, the shape of a submitted answer.
NOT_AN_OFFICE = {"wealth_manager": "wealth manager", "ria_with_fo_practice": "RIA with a family-office practice", "embedded_fo_practice": "family-office practice"}
LOOSE_EMAIL = "[\\w.+-]+@[\\w-]+\\.[\\w.]+"
ANSWER = (
    "verdict string, picks array<struct<firm: string, fit_summary: string, confidence: string, evidence: array<string>, caveats: array<string>, outreach: string>>, "
    "watchlist array<struct<firm: string, what_changed: string, recommendation: string, observed_at: string>>, abstained array<string>, coverage_note string, next_steps array<string>, limitations array<string>"
)
CONFIDENCE, WATCH_ADVICE = ["strong", "moderate", "weak"], ["re-verify before contacting", "stop trusting", "monitor"]
MAX_STEPS = 10
REFUSED = "No answer can be released: every attempt said something that the records do not support."
OUT_OF_SCOPE = "The question is outside what the records cover."


def allowed(hits: DataFrame) -> DataFrame:
    """(id, email): the addresses of each answer's records, in lower case, once each."""
    both = F.explode(F.array(F.lower("email"), F.lower("secondary_email"))).alias("email")
    return hits.select("id", both).filter("email is not null and email <> ''").distinct()


def quarantined(hits: DataFrame, audit: DataFrame) -> DataFrame:
    """(id, email): rejected addresses (crd, email) of the firms that an answer's records are of."""
    return hits.select("id", "crd").join(audit.select("crd", F.lower("email").alias("email")), "crd").select("id", "email").distinct()


def grounding_failures(answers: DataFrame, hits: DataFrame, audit: DataFrame) -> DataFrame:
    """(id, check, detail, blocks) for answers (id, text, total) against their records (id, crd, name, category, email, secondary_email).

    Blocking: an address that no record has, a rejected address of a firm among the records, a firm that is no office of
    its own called one without its label. A count that is not the total is a warning.
    """
    low = F.lower(F.coalesce("text", F.lit("")))
    row = lambda check, detail, blocks: (F.lit(check).alias("check"), detail.alias("detail"), F.lit(blocks).alias("blocks"))
    said = answers.select("id", F.explode(F.array_distinct(emails_in(F.col("text")))).alias("email"))
    strange = said.join(allowed(hits), ["id", "email"], "left_anti").select("id", *row("email not on a record", F.col("email"), True))
    exposed = quarantined(hits, audit).join(answers, "id").filter(F.contains(low, F.col("email"))).select("id", *row("rejected address", F.col("email"), True))
    claims = F.filter(count_claims(F.col("text")), lambda n: n != F.col("total"))
    counts = answers.filter("total is not null").select("id", F.explode(F.array_distinct(claims)).alias("n")).select("id", *row("count is not the total", F.col("n").cast("string"), False))
    label = F.create_map(*(F.lit(x) for kv in NOT_AN_OFFICE.items() for x in kv))[F.col("category")]
    named = hits.select("id", "name", label.alias("label"), fold(F.col("name")).alias("n")).filter("label is not null and n <> ''").join(answers, "id")
    wrong = F.contains(fold(F.col("text")), F.col("n")) & F.contains(low, F.lit("family office")) & ~F.contains(low, F.lower("label"))
    mislabelled = named.filter(wrong).select("id", *row("called an office", F.col("name"), True)).distinct()
    return strange.unionByName(exposed).unionByName(counts).unionByName(mislabelled)


def verdicts(answers: DataFrame, failures: DataFrame) -> DataFrame:
    """(id, ok, failures, warnings) of each answer."""
    counted = failures.groupBy("id").agg(F.count_if("blocks").alias("failures"), F.count_if(~F.col("blocks")).alias("warnings"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return answers.select("id").join(counted, "id", "left").select("id", (F.coalesce("failures", F.lit(0)) == 0).alias("ok"), zero("failures"), zero("warnings"))


def routed(queries: DataFrame, strict: DataFrame, loose: DataFrame, floor: float = FLOOR) -> DataFrame:
    """(id, route, ids, note) of queries (id, intent, filtered, nearest) with hits (id, hit, rank) under their filters and without.

    A query whose nearest record is beyond the floor, or that has none, is out of scope before anything else. A discovery
    whose filters nothing passes falls back to the nearest without them, and says so.
    """
    listed = lambda hits, name: hits.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "hit"))), lambda h: h["hit"]).alias(name))
    rows = queries.join(listed(strict, "strict"), "id", "left").join(listed(loose, "loose"), "id", "left")
    out = F.col("nearest").isNull() | (F.col("nearest") > floor)
    intent = F.when(F.col("intent").isin("lookup", "aggregate"), F.col("intent")).otherwise("discovery")
    fallback = (intent == "discovery") & F.col("filtered") & F.col("strict").isNull()
    none = F.array().cast(dict(rows.dtypes)["strict"])
    ids = F.when(out, none).when(fallback, F.coalesce("loose", none)).otherwise(F.coalesce("strict", none))
    return rows.select("id", F.when(out, "out_of_scope").otherwise(intent).alias("route"), ids.alias("ids"), F.when(~out & fallback, "no record passed the filters; these are nearest only").alias("note"))


def composed(questions: DataFrame, compose: Callable[[DataFrame], DataFrame], check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, text, outcome): answers that are composed, checked, repaired once, and refused if that does not help.

    compose gives (id, text) for questions, which have `repair`, the failures to avoid, the second time; check gives
    the blocking failures (id, detail) of answers (id, text).
    """
    first = compose(questions.withColumn("repair", F.lit(None).cast("array<string>")))
    failed = check(first).groupBy("id").agg(F.array_sort(F.collect_set("detail")).alias("repair"))
    second = compose(questions.join(failed, "id"))
    still = check(second).select("id").distinct().withColumn("refused", F.lit(True))
    told = first.join(failed.select("id").withColumn("failed", F.lit(True)), "id", "left").join(second.withColumnRenamed("text", "again"), "id", "left").join(still, "id", "left")
    outcome = F.when(F.col("failed").isNull(), "released").when(F.col("refused").isNull(), "repaired").otherwise("refused")
    return told.select("id", F.when(outcome == "released", F.col("text")).when(outcome == "repaired", F.col("again")).otherwise(REFUSED).alias("text"), outcome.alias("outcome"))


def parsed_answer(body: Column) -> tuple[Column, Column]:
    """(answer, problems): a submitted answer as a struct, and what is wrong with its shape (empty: nothing)."""
    a = F.from_json(body, ANSWER)
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    none = lambda c: F.coalesce(c, F.lit(False))
    tests = [
        (empty(a["verdict"]), "verdict"),
        (none(F.exists(a["picks"], lambda p: empty(p["firm"]) | empty(p["fit_summary"]))), "pick without firm or reason"),
        (none(F.exists(a["picks"], lambda p: ~F.coalesce(p["confidence"].isin(CONFIDENCE), F.lit(False)))), "confidence"),
        (none(F.exists(a["picks"], lambda p: F.coalesce(F.size(p["evidence"]), F.lit(0)) < 1)), "pick without evidence"),
        (none(F.exists(a["watchlist"], lambda w: ~F.coalesce(w["recommendation"].isin(WATCH_ADVICE), F.lit(False)) | empty(w["what_changed"]))), "watchlist"),
    ]
    return a, F.filter(F.array(*(F.when(c, F.lit(n)) for c, n in tests)), lambda x: x.isNotNull())


def free_text(a: Column) -> Column:
    """All that a reader sees of an answer besides the picks."""
    lists = [F.array_join(F.coalesce(a[c], F.array().cast("array<string>")), " ") for c in ("abstained", "next_steps", "limitations")]
    watch = F.array_join(F.transform(F.coalesce(a["watchlist"], F.array().cast("array<struct<firm: string, what_changed: string, recommendation: string, observed_at: string>>")), lambda w: w["what_changed"]), " ")
    return F.concat_ws(" ", a["verdict"], a["coverage_note"], *lists, watch)


def loose_emails(text: Column) -> Column:
    """Addresses in prose, in lower case, without the stop of a sentence."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(LOOSE_EMAIL), F.lit(0)), lambda e: F.rtrim(F.lower(e), F.lit("."))))


def goal_failures(goals: DataFrame, records: DataFrame, context: DataFrame, places: DataFrame) -> DataFrame:
    """(goal, failure, detail) of answers (goal, prose, picks, watch: arrays of firms) against what their tools returned.

    records: (goal, name, pickable, city, emails) that were returned; context: (goal, name) that were only shown;
    places: (goal, place) that the goal states. Firms are matched by name as a whole, whatever its case.
    """
    prose = F.coalesce("prose", F.lit(""))
    row = lambda failure, detail: (F.lit(failure).alias("failure"), detail.alias("detail"))
    pushed = context.join(goals.select("goal", "prose"), "goal").filter(recommends(prose, F.col("name"))).select("goal", *row("recommends what is not released", F.col("name")))
    known = records.select("goal", F.explode(F.transform("emails", F.lower)).alias("email")).distinct()
    strange = goals.select("goal", F.explode(loose_emails(prose)).alias("email")).join(known, ["goal", "email"], "left_anti").select("goal", *row("address not on a record", F.col("email")))
    named = records.select("goal", F.lower(F.trim("name")).alias("key"), "pickable", F.upper(F.trim("city")).alias("city"))
    firms = lambda c: goals.select("goal", F.explode(c).alias("firm")).withColumn("key", F.lower(F.trim("firm"))).join(named, ["goal", "key"], "left")
    found = []
    for column, absent, closed in (("picks", "pick is no record", "pick is not releasable"), ("watch", "watched firm is no record", "watched firm was never released")):
        each = firms(column)
        found.append(each.filter("pickable is null").select("goal", *row(absent, F.col("firm"))))
        found.append(each.filter("not pickable").select("goal", *row(closed, F.col("firm"))))
    met = firms("picks").filter("city is not null").select("goal", F.col("city").alias("place")).distinct()
    asked = places.select("goal", F.upper(F.trim("place")).alias("place")).distinct().join(met, ["goal", "place"], "left_anti").join(goals.select("goal", "prose"), "goal")
    silent = asked.filter(~F.contains(F.lower(prose), F.lower("place"))).select("goal", *row("place is neither met nor mentioned", F.col("place")))
    out = pushed.unionByName(strange).unionByName(silent)
    for more in found:
        out = out.unionByName(more)
    return out


def merged_grounding(old: DataFrame, new: DataFrame, key: str = "crd") -> DataFrame:
    """Records of a session with those of a later tool laid over them: what the later one knows wins, the rest survives."""
    columns = list(dict.fromkeys(c for c in (*old.columns, *new.columns) if c != key))
    a, b = (d.withColumnsRenamed({c: f"#{x}{c}" for c in d.columns if c != key}) for d, x in ((old, "a"), (new, "b")))
    pick = lambda c: F.coalesce(*(F.col(f"#{x}{c}") for x, d in (("b", new), ("a", old)) if c in d.columns)).alias(c)
    return a.join(b, key, "full").select(key, *map(pick, columns))


def run_tools(plan: Callable[[list[dict]], dict], tools: dict[str, Callable[[dict], object]], steps: int = MAX_STEPS) -> tuple[object, list[dict]]:
    """(answer, log) of a goal: the planner sees the log and names a tool and its arguments, or submits.

    A call that was made before is not made again, a tool's failure is information, and after the last step only a
    submission counts; without one the answer is None.
    """
    log: list[dict] = []
    made: set[str] = set()
    for step in range(steps + 1):
        call = plan(log)
        name, args = call["tool"], call.get("args", {})
        entry = {"step": step, "tool": name, "status": "ok"}
        log.append(entry)
        if name == "submit":
            return args, log
        if step == steps:
            entry["status"] = "out of steps"
            break
        key = f"{name}:{sorted(args.items())}"
        if key in made:
            entry["status"] = "repeated"
            continue
        made.add(key)
        try:
            entry["result"] = tools[name](args)
        except Exception as e:
            entry["status"] = f"error: {type(e).__name__}"
    return None, log
