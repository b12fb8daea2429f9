"""Publication: the checks across surfaces, exports by state and order, the ledger dump, and the cycle with its gates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.rules import COUNTED
from quillon.operators.release import surface
from quillon.operators.serving import GRADES, OFFICES

# Grades that never ship, what a person's status may be, and the wording of signals.
REJECTED_GRADES = ["D", "F"]
PERSON_STATUS = ["proven", "not_established"]
LATEST, NO_SIGNAL = " signal(s); latest ", "no recent signal found"
#: Surfaces: which records, and in which columns (with their headers).
FIRM_COLUMNS = {"crd": "CRD", "name": "Firm Name", "category": "Entity Category", "domain": "Domain", "state": "State"}
PRODUCT_COLUMNS = FIRM_COLUMNS | {"name": "Family Office Name", "email": "Primary Email", "grade": "Primary Email Grade", "completion": "Data Completion", "sectors": "Investing Sectors"}
QUARANTINE_COLUMNS = {"crd": "CRD", "name": "Firm Name", "category": "Entity Category"}
PHASES = ["observe", "resolve", "discover", "promote", "rebuild"]


def export_order() -> list[Column]:
    """What can be acted on first: the better address, the fuller record, the name."""
    grade = F.coalesce("grade", F.lit("Z"))
    rank = F.when(grade.isin(GRADES[:3]), F.array_position(F.array(*map(F.lit, GRADES)), grade) - 1).otherwise(6)
    return [rank, F.desc("completion"), F.asc("name"), F.asc("crd")]


#: The export of each part of release.surface, with its columns and its order.
SURFACES = {
    "product": "family_offices", "practices": "practices", "pending": "pending_decision_maker", "reclassified": "reclassified", "quarantined": "quarantined",
    "awaiting_adjudication": "awaiting_adjudication",
}


def placed(records: DataFrame) -> DataFrame:
    """records with the name of the one surface that each is exported on; every record has one."""
    names = F.create_map(*(F.lit(x) for pair in SURFACES.items() for x in pair))
    return records.withColumn("surface", F.element_at(names, surface(F.col("release_state"), F.col("category"))))


def surfaces(records: DataFrame) -> dict[str, tuple[DataFrame, dict[str, str], list[Column]]]:
    """The six record surfaces, each with its columns and its order."""
    firms = [F.asc("category"), F.asc("name"), F.asc("crd")]
    forms = {"family_offices": (PRODUCT_COLUMNS, export_order()), "practices": (PRODUCT_COLUMNS, export_order()), "quarantined": (QUARANTINE_COLUMNS, firms[1:])}
    rows = placed(records)
    return {n: (rows.filter(F.col("surface") == n).drop("surface"), *forms.get(n, (FIRM_COLUMNS, firms))) for n in SURFACES.values()}


def signal_summary(signals: DataFrame) -> DataFrame:
    """(crd, summary): how many signals (crd, type, date, description) a firm has, and the newest."""
    newest = F.max(F.struct("date", "type", "description"))
    each = signals.groupBy("crd").agg(F.count("*").alias("n"), newest.alias("s"))
    said = F.concat(F.col("n").cast("string"), F.lit(LATEST), F.col("s.date"), F.lit(" ("), F.col("s.type"), F.lit("): "), F.left("s.description", F.lit(80)))
    return each.select("crd", said.alias("summary"))


def export(records: DataFrame, signals: DataFrame, path: str) -> dict[str, str]:
    """Writes all surfaces, and the signals, as CSV below path, each in its own order under its own headers; lists are joined by "; "."""
    lists = {c for c, t in records.dtypes if t.startswith("array")}
    summary = signal_summary(signals)
    out = {}
    for name, (rows, columns, order) in surfaces(records).items():
        sorted_rows = rows
        if columns is PRODUCT_COLUMNS:
            sorted_rows = rows.join(summary, "crd", "left")
        shown = [(F.array_join(c, "; ") if c in lists else F.col(c)).alias(h) for c, h in columns.items()]
        if columns is PRODUCT_COLUMNS:
            shown.append(F.coalesce("summary", F.lit(NO_SIGNAL)).alias("Recent Signals"))
        # A range sort: files are in order, and no task holds a whole surface.
        sorted_rows.orderBy(*order).select(*shown).write.mode("overwrite").option("header", True).option("escape", "\"").csv(f"{path}/{name}")
        out[name] = f"{path}/{name}"
    signals.orderBy("crd", F.desc("date")).write.mode("overwrite").option("header", True).option("escape", "\"").csv(f"{path}/signals")
    return out | {"signals": f"{path}/signals"}


def read_surface(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A surface as it was shipped, every column a string."""
    shape = ", ".join(f"`{h}` string" for h in [*columns.values(), *(["Recent Signals"] if columns is PRODUCT_COLUMNS else [])])
    return spark.read.schema(shape).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def served_addresses(records: DataFrame) -> DataFrame:
    """(crd, email): every address on a qualifying record, in lower case."""
    both = F.explode(F.array(F.lower("email"), F.lower("secondary_email"))).alias("email")
    return records.filter("release_state = 'qualifying'").select("crd", both).filter("email is not null and trim(email) <> ''")


def leaked(records: DataFrame, audit: DataFrame) -> DataFrame:
    """Qualifying records that carry an address that was rejected (email), in either place."""
    return served_addresses(records).join(audit.select(F.lower("email").alias("email")).distinct(), "email", "left_semi").select("crd").distinct()


def _row(checks: dict[str, Column]) -> Column:
    return F.explode(F.array(*(F.struct(F.lit(n).alias("check"), c.cast("long").alias("found")) for n, c in checks.items())))


def record_checks(records: DataFrame, contacts: DataFrame, audit: DataFrame) -> DataFrame:
    """(check, found, ok): the checks that need no export, counted in one pass over the records joined to what they claim."""
    ratified = contacts.filter("role = 'primary'").select("crd").distinct().withColumn("#ratified", F.lit(True))
    rows = records.join(ratified, "crd", "left").join(leaked(records, audit).withColumn("#leaked", F.lit(True)), "crd", "left")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    q, person = F.col("release_state") == "qualifying", F.col("contact_name").isNotNull() | F.col("email").isNotNull()
    unproven = F.col("#ratified").isNull()
    tests = {
        "proven decision-makers are ratified": q & (F.col("person_status") == "proven") & unproven,
        "no unratified contact ships": q & person & unproven,
        "person_status is in the vocabulary": q & ~F.coalesce(F.col("person_status").isin(PERSON_STATUS), F.lit(False)),
        "entity-only records present nobody": q & (F.col("person_status") == "not_established") & person,
        "gate-released records carry their evidence": q & (F.col("release_basis") == "gate_released") & empty("release_basis_detail"),
        "qualifying records state a basis": q & F.col("release_basis").isNull(),
        "qualifying records carry a trust state": q & F.col("trust_state").isNull(),
        "flagged records state a reason": (F.col("trust_state") == "flagged") & empty("trust_reason"),
        "qualifying records carry a date": q & F.col("data_asof").isNull(),
        "no rejected address on a qualifying record": q & F.col("#leaked").isNotNull(),
        "no rejected grade on a qualifying record": q & F.col("grade").isin(REJECTED_GRADES) & ~empty("email"),
    }
    counts = rows.agg(*(F.count_if(t).alias(n) for n, t in tests.items()), F.count_if(q & F.col("category").isin(OFFICES)).alias("some qualifying offices exist"))
    listed = counts.select(_row({n: F.col(f"`{n}`") for n in [*tests, "some qualifying offices exist"]}).alias("c")).select("c.*")
    return listed.withColumn("ok", F.when(F.col("check") == "some qualifying offices exist", F.col("found") > 0).otherwise(F.col("found") == 0))


def surface_checks(records: DataFrame, shipped: dict[str, DataFrame], audit: DataFrame, index: DataFrame) -> DataFrame:
    """(check, found, ok): what was shipped, and what can be retrieved (index: crd), against the records; found counts differences.

    One pass over the records and one over all that was shipped; both end in one row.
    """
    state, category, found, at = F.col("release_state"), F.col("category"), F.col("#found").isNotNull(), F.col("surface")
    wanted = list(SURFACES.values())
    held = placed(records).join(index.select("crd").distinct().withColumn("#found", F.lit(True)), "crd", "left").agg(
        *(F.count_if(at == n).alias(f"held {n}") for n in wanted), F.count("*").alias("all"), F.count_if(state == "qualifying").alias("qualifying"), F.count_if(found & (at == "quarantined")).alias("quarantined found"),
        F.count_if(found & (at == "reclassified")).alias("reclassified found"), F.count_if(~found & (state == "qualifying") & category.isin(OFFICES)).alias("offices lost"))
    parts = None
    for name, rows in shipped.items():
        address = [F.col(f"`{h}`") if h in rows.columns else F.lit(None).cast("string") for h in ("Primary Email", "Primary Email Grade")]
        part = rows.select(F.lit(name).alias("surface"), F.col("`Entity Category`").alias("c"), F.lower(F.trim(address[0])).alias("email"), address[1].alias("g"))
        parts = part if parts is None else parts.unionByName(part)
    rejected = audit.select(F.lower("email").alias("email")).distinct().withColumn("#bad", F.lit(True))
    product = F.col("surface") == "family_offices"
    out = parts.join(rejected, "email", "left").agg(
        *(F.count_if(F.col("surface") == n).alias(f"sent {n}") for n in wanted), F.count_if(product & ~F.coalesce(F.col("c").isin(OFFICES), F.lit(False))).alias("others"),
        F.count_if(product & F.col("#bad").isNotNull()).alias("addresses"), F.count_if(product & F.col("g").isin(REJECTED_GRADES) & (F.coalesce("email", F.lit("")) != "")).alias("grades"),
        F.count_if((F.col("surface") == "reclassified") & F.coalesce(F.col("c").isin(COUNTED), F.lit(False))).alias("wrongly"))
    c = lambda n: F.col(f"`{n}`")
    sent = sum((c(f"sent {n}") for n in wanted), F.lit(0))
    tests = {f"{n} as shipped are those held": F.abs(c(f"sent {n}") - c(f"held {n}")) for n in wanted} | {
        "the surfaces partition all held records": F.abs(sent - c("all")),
        "qualifying records are the offices and practices": F.abs(c("qualifying") - c("sent family_offices") - c("sent practices")),
        "the product has offices only": c("others"),
        "no rejected address was shipped": c("addresses"),
        "no rejected grade was shipped": c("grades"),
        "reclassified firms are no offices": c("wrongly"),
        "quarantined firms cannot be retrieved": c("quarantined found"),
        "reclassified firms cannot be retrieved": c("reclassified found"),
        "qualifying offices can be retrieved": c("offices lost"),
    }
    both = held.withColumn("one", F.lit(1)).join(out.withColumn("one", F.lit(1)), "one")
    return both.select(_row(tests).alias("c")).select("c.check", "c.found", (F.col("c.found") == 0).alias("ok"))


def trust_of_real_runs(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Trust events (run_id, and more) of runs (run_id, config: JSON) that wrote; dry runs say nothing about a record."""
    real = runs.filter(F.coalesce(F.get_json_object("config", "$.write"), F.lit("false")) == "true").select("run_id")
    return events.join(real, "run_id")


def dump(tables: dict[str, DataFrame], orders: dict[str, list[str]], path: str) -> DataFrame:
    """Writes tables as JSON lines in the order of their keys; returns the manifest (table, rows, folder) of what was written."""
    manifest = None
    for name, rows in tables.items():
        rows.orderBy(*orders[name]).write.mode("overwrite").json(f"{path}/{name}")
        back = rows.sparkSession.read.schema(rows.schema).json(f"{path}/{name}")
        row = back.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(f"{name}").alias("folder"))
        manifest = row if manifest is None else manifest.unionByName(row)
    return manifest


class ReleaseStopped(RuntimeError):
    """A gate has failed; what came after it has not run."""


def gated_release(before: Callable[[], DataFrame], publish: Callable[[], None], after: Callable[[], DataFrame]) -> dict[str, int]:
    """Checks before publication stop it, checks after it fail the run; returns how many were made."""
    made = {}
    for name, checks in (("before", before), ("after", after)):
        rows = checks().collect()  # one row for each check
        made[name] = len(rows)
        failed = sorted(r["check"] for r in rows if not r["ok"])
        if failed:
            raise ReleaseStopped(f"checks {name} publication failed: {', '.join(failed)}")
        if name == "before":
            publish()
    return made


def run_cycle(spark: SparkSession, phases: dict[str, Callable[[], int]], run_id: int = 0) -> DataFrame:
    """Runs the phases of a cycle in their order and returns its ledger (run_id, seq, phase, status, detail).

    A failure ends the cycle, is recorded, and is not raised, so that the ledger is always closed.
    """
    rows, status = [], "ok"
    for phase in PHASES:
        if phase not in phases:
            continue
        try:
            rows.append((run_id, len(rows), phase, "ok", str(phases[phase]())))
        except Exception as e:
            status = "failed"
            rows.append((run_id, len(rows), phase, "error", f"{type(e).__name__}: {e}"))
            break
    rows.append((run_id, len(rows), "close", status, f"{len(rows)} phases"))
    return spark.createDataFrame(rows, "run_id long, seq int, phase string, status string, detail string")


def code_version(today: dt.date, revision: str | None = None) -> str:
    """The stamp that a run stores: the revision, or the day where there is none."""
    return revision or today.isoformat()
