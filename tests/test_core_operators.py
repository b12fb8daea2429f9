"""Edge cases of operators that the query tables do not hold."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from quillon.functions import dates, rules, text
from quillon.operators import contacts, entities, keyed, ledger, retrieval
from quillon.sources import feeds, pages


def values(spark, column, *rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_name_parts(spark):
    names = ["José O'Brien", "Putnam, III", "Eliza (Happy) Rowe", "Cher", "III", "", "Ann B. Lee, CFA"]
    first, last = text.name_parts(F.col("x"))
    assert values(spark, first, *names) == ["jose", "putnam", "eliza", "cher", None, None, "ann"]
    assert values(spark, last, *names) == ["obrien", None, "rowe", None, None, None, "lee"]


def test_title_key_spells_out(spark):
    assert values(spark, text.title_key(F.col("x")), "Sr. VP & CIO", "Senior Vice President and Chief Investment Officer", None) == ["senior vice president chief investment officer"] * 2 + [""]


def test_title_rank(spark):
    assert values(spark, rules.title_rank(F.col("x")), "Co-Founder", "Vice President", "President", "CIO", "Analyst", None) == [100, 10, 85, 80, 10, 10]


def test_websites_and_phones(spark):
    assert values(spark, text.website(F.col("x")), "example.com", " http://x.org ", "a b", "", None, "ftp://x") == ["https://example.com", "http://x.org", None, None, None, None]
    assert values(spark, text.registered_domain(F.col("x")), "https://WWW.X.org:80/a?b", "x") == ["x.org:80", ""]
    assert values(spark, text.phone_digits(F.col("x")), "+1 (555) 010-1234", "123", None) == ["5550101234", None, None]


def test_dates(spark):
    today = F.lit("2026-06-30").cast("date")
    assert values(spark, dates.months_since(F.col("x"), today), "2026-02", "2024-06-01", "soon", None) == [4, 24, None, None]
    assert values(spark, dates.recency(F.col("x"), today), "2026-02", "2024-06-01", "2020-01", None) == [1.0, 0.5, 0.0, 0.0]
    assert values(spark, dates.iso_date(F.col("x")), "3/7/2026", "13/40/2026") == ["2026-03-07", None]


def test_gate_boundaries(spark):
    rows = [
        ("A Family Office", "our family office team, a family office", None, 1, 100, 95, 1, 1, 5, None, None),  # name, practice, self-description, shape
        ("Plain Advisers", "a family office practice", "family office", 1, 100, 10, 1, 200, 5, None, None),  # embedded in spite of retail
        ("A Family Office", None, None, 0, 100, 95, 1, 1, 5, None, None),  # the registry alone never affirms
        (None, None, None, 0, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "name string, site string, free_text string, page int, raum long, hnw_raum long, hnw int, other int, employees int, domain string, profile string").withColumn("fo_page", F.lit(False))
    got = [(r.score, r.decision, r.category) for r in rules.gate(df).collect()]
    assert got == [(105, "affirm", "single_family_office"), (15, "affirm", "embedded_fo_practice"), (60, "needs_evidence", None), (0, "exclude", None)]


def test_email_grades(spark):
    rows = [(1, 0, "a", "ok"), (2, 0, "a", "invalid"), (2, 1, "b", "invalid"), (3, 0, "a", "unknown"), (3, 1, "b", "ok"), (4, 0, "a", "unknown"), (5, 0, "a", "invalid"), (5, 1, "b", "catch_all"), (6, 4, "z", "ok"), (6, 0, "a", "invalid")]
    df = spark.createDataFrame(rows, "k int, pos int, email string, result string").withColumn("pattern", F.lit("p"))
    got = {r.k: (r.email, r.grade) for r in contacts.graded(df, ["k"]).collect()}
    assert got == {1: ("a", "A"), 2: ("a", "D"), 3: ("b", "A"), 4: ("a", "C"), 5: ("a", "B"), 6: ("a", "D")}


def test_oscillation_vectors(spark):
    cases = [([1, 2], 1, "oscillating"), ([1, 2, 1], 1, "oscillating"), ([1, 1, 1], 2, "unconfirmed"), ([1, 2], 2, "confirmed"), ([], 1, "unconfirmed"), ([3], 3, "confirmed")]
    df = spark.createDataFrame(cases, "past array<int>, now int, want string").withColumn("past", F.transform("past", lambda v: F.struct(v.alias("v"))))
    assert [r[0] for r in df.select(ledger.oscillation(F.col("past"), F.col("now"))).collect()] == [c[2] for c in cases]


def test_reach_transitions(spark):
    seq = ["200", "404", "200", "429", "error:x", "error:x", "202"]
    df = spark.createDataFrame([(i, 1, i, s, None) for i, s in enumerate(seq)], "id int, key int, at int, status string, content long")
    got = [r.change for r in ledger.observed_changes(df).orderBy("id").collect()]
    assert got == ["none", "dark", "recovered", "throttled", "none", "dark", "recovered"]


def test_keyed_operators(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, keyed.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, keyed.new_captures(new.union(new), old, ["k"], F.asc("v")).collect())) == [(3, "d")]
    assert [tuple(r) for r in keyed.keep_children(new, old, ["k"]).collect()] == [(2, "c")]
    assert sorted(map(tuple, keyed.preserve(new, old, ["k"], ["v"]).collect()), key=str) == [(2, "b"), (3, None)]


def test_fusion_ties(spark):
    v = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query int, id int, rank int")
    w = spark.createDataFrame([(1, 12, 1), (1, 11, 2)], "query int, id int, rank int")
    assert [(r.id, r.matched) for r in retrieval.fused(v, w).orderBy("rank").collect()] == [(11, "both"), (10, "vector"), (12, "lexical")]


def test_not_held_and_facts_on_empty_tables(spark):
    empty = spark.createDataFrame([], "key string, name string")
    one = spark.createDataFrame([Row(key="k", name="N, Inc.")])
    assert entities.not_held(one, empty).count() == 1
    assert entities.not_held(one, spark.createDataFrame([Row(key="z", name="n inc")])).count() == 0


def test_pages(spark):
    html = "<title> A\n b</title><script>x</script><p>Hi &amp; <b>you</b>"
    df = spark.createDataFrame([(1, "https://a.org/", html), (2, "https://a.org/x", None)], "page_id long, url string, html string")
    assert {r.page_id: (r.title, r.text) for r in pages.parsed(df).collect()} == {1: ("A b", "Hi & you"), 2: ("", "")}
    found = pages.spans(spark.createDataFrame([(1, "a thing and a thing")], "id long, text string"), "thing", around=4)
    assert found.first().spans == ["a thing and", "d a thing"]


def test_submission_and_snapshot(spark):
    head = "EIN: 12-3\nBUSINESS ADDRESS:\n STREET 1: 1 Main\n CITY: Troy\n STATE: NY\nMAIL ADDRESS:\n CITY: No"
    got = spark.createDataFrame([(head,)], "x string").select(*(c.alias(k) for k, c in feeds.submission_profile(F.col("x")).items())).first()
    assert (got.street, got.city, got.state, got.phone, got.ein) == ("1 Main", "Troy", "NY", None, "12-3")
    answer = '{"hits": {"hits": [{"_source": {"iacontent": "{\\"basicInformation\\": {\\"firmName\\": \\"A\\", \\"iaScope\\": \\"ACTIVE\\", \\"advFilingDate\\": \\"2/3/2026\\"}}"}}]}}'
    snap = values(spark, feeds.registry_snapshot(F.col("x")), answer, '{"hits": {"hits": []}}')
    assert tuple(snap[0]) == (True, "A", "ACTIVE", "2026-02-03") and snap[1].found is False


def test_missing_csv_gives_no_rows(spark, tmp_path):
    assert feeds.csv_if_there(spark, f"file://{tmp_path}/none.csv", "a string").count() == 0
    (tmp_path / "x.csv").write_text('a,b\n"1, ""x""",2\n')
    assert feeds.csv_if_there(spark, f"file://{tmp_path}/x.csv", "a string, b int").first().a == '1, "x"'


def test_distances_of_many_queries_in_blocks(spark, monkeypatch):
    """No query vector reaches the driver, and every query meets every record."""
    monkeypatch.setattr(retrieval, "BLOCK", 7)
    rows = [(i, [float((i * k) % 11 - 5) for k in range(1, 7)] + [1.0]) for i in range(60)]
    index = spark.createDataFrame(rows, "id int, vector array<float>")
    asked = index.filter("id % 2 = 0").withColumnRenamed("id", "query")
    with monkeypatch.context() as m:
        m.setattr(type(asked), "collect", lambda self: 1 / 0)
        far = retrieval.distances(index, asked)
    got = {(r["query"], r["id"]): r["distance"] for r in far.collect()}
    assert len(got) == 30 * 60
    for (q, i), d in got.items():
        a, b = rows[q][1], rows[i][1]
        norm = lambda v: sum(x * x for x in v) ** 0.5
        assert abs(d - (1 - sum(x * y for x, y in zip(a, b)) / norm(a) / norm(b))) < 1e-9


def test_count_claims_after_400_characters(spark, tmp_path):
    from quillon.plans.retrieval import count_claim_check

    spark.createDataFrame([(3, "x" * 500 + " found 7 firms"), (7, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["id"]: r.wrong for r in count_claim_check(spark, str(tmp_path)).collect()} == {3: [7, 7], 7: None}


def test_once_keeps_filters_above(spark):
    from quillon.functions.plan import once

    df = once(spark.range(10), {"x": F.col("id") * 2, "id": F.col("id") + 1}).filter("x > 15")
    assert sorted(map(tuple, df.select("id", "x").collect())) == [(9, 16), (10, 18)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_fingerprint_tells_null_from_empty_and_parts_apart(spark):
    rows = [(None, "a"), ("a", None), ("", "a"), ("a", ""), ("a|", "b"), ("a", "|b"), ("1:a", "b"), ("1", ":ab")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(keyed.fingerprint(F.col("a"), F.col("b"))).collect()]
    assert len(set(got)) == len(rows)


def test_history_holds_nulls(spark):
    rows = [(1, "a"), (2, None), (3, "a"), (4, None), (5, None)]
    df = spark.createDataFrame(rows, "at int, v string").withColumn("k", F.lit(1))
    past = df.withColumn("past", ledger.history(F.col("v"), ["k"], F.col("at"), n=2))
    assert {r["at"]: [x.v for x in r.past] for r in past.collect()} == {1: [], 2: ["a"], 3: ["a", None], 4: [None, "a"], 5: ["a", None]}
    got = past.withColumn("past", ledger.history(F.col("v"), ["k"], F.col("at"))).select("at", ledger.oscillation(F.col("past"), F.col("v")).alias("o"))
    assert {r["at"]: r.o for r in got.collect()} == {1: "unconfirmed", 2: "unconfirmed", 3: "oscillating", 4: "oscillating", 5: "oscillating"}


def test_fair_order_is_the_first_of_the_whole_order(spark):
    rows = [(i, None if i % 3 == 0 else (i * 7919 % 50) * 3_600_000_000) for i in range(120)]
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    df = spark.createDataFrame(rows, "key int, last long")
    for share in (0.1, 0.34, 0.5, 1.0):
        assert sorted(r["key"] for r in ledger.fair_order(df, share, 7).collect()) == sorted(k for k, _ in want[: max(7, -int(-(share * 120) // 1))])
    assert ledger.fair_order(df.limit(0)).count() == 0


def test_names_in_one_answer_are_bounded(spark):
    import pytest
    from quillon.operators import review

    held = spark.createDataFrame([(1, "Alpha LLC"), (2, "Alpha Two"), (3, "Beta")], "key int, held string")
    asked = spark.createDataFrame([("alpha",), ("BETA ",), ("Alpha llc",), ("none",)], "name string")
    assert {r["name"]: r["key"] for r in review.resolved_names(asked, held).collect()} == {"alpha": None, "BETA ": 3, "Alpha llc": 1}
    with pytest.raises(ValueError):
        review.resolved_names(asked, held, most=2)


def test_places_and_recommendations_in_any_place(spark):
    from quillon.operators import review

    goals = spark.createDataFrame([(1, "in New  York or Baden-Baden"), (2, "new yorker"), (3, None), (4, "ÎLE")], "id int, text string")
    places = spark.createDataFrame([("New York",), ("Baden-Baden",), ("York",), (None,)], "place string")
    assert sorted(tuple(r) for r in review.stated_places(goals, places).collect()) == [(1, "Baden-Baden"), (1, "New York")]
    text = "Hidden (Partners) is old. " + "x" * 300 + " consider Hidden (Partners)"
    assert values(spark, review.recommends(F.col("x"), F.lit("hidden (partners)")), text, text[:200], "", None) == [True, False, False, False]


def test_stems(spark):
    from quillon.functions import search

    words = ["classes", "stories", "gas", "bus", "firms", "running", "sing", "invested", "red", "daily", "ly", "status", "analysis"]
    assert values(spark, search.stem(F.col("x")), *words) == ["class", "story", "gas", "bus", "firm", "runn", "sing", "invest", "red", "dai", "ly", "status", "analysis"]


def test_lexical_index(spark):
    docs = spark.createDataFrame([(1, "Firms invest, firm by firm"), (2, "a firm"), (3, None), (4, ""), (5, "investing firms")], "id int, text string")
    asked = spark.createDataFrame([(7, "the investing firm"), (8, "the of"), (9, None)], "query int, text string")
    got = [(r["query"], r["id"], r["rank"]) for r in retrieval.lexical(retrieval.inverted_index(docs), asked).orderBy("rank").collect()]
    assert got == [(7, 1, 1), (7, 5, 2)]


def test_dense_by_matrix_and_by_blocks_alike(spark, monkeypatch):
    rows = [(i, [float((i * k) % 13 - 6) for k in range(1, 9)]) for i in range(90)] + [(200, [0.0] * 8), (201, [1.0])]
    index = spark.createDataFrame(rows, "id int, vector array<float>").repartition(5)
    asked = index.filter("id < 12 and id > 0").withColumnRenamed("id", "query")
    by_matrix = sorted((r["query"], r["rank"], r["id"]) for r in retrieval.dense(index, asked, 6).collect())
    monkeypatch.setattr(retrieval, "MATRIX", 3)
    by_block = sorted((r["query"], r["rank"], r["id"]) for r in retrieval.dense(index.filter("id < 200"), asked, 6).collect())
    assert by_matrix == by_block and len(by_matrix) == 66
    assert retrieval.dense(index, asked.limit(0)).count() == 0


def test_gates_stop_publication(spark):
    import pytest
    from quillon.operators import publishing

    checks = lambda ok: spark.createDataFrame([("c", ok)], "check string, ok boolean")
    done = []
    with pytest.raises(publishing.ReleaseStopped, match="before"):
        publishing.gated_release(lambda: checks(False), lambda: done.append(1), lambda: checks(True))
    assert not done
    with pytest.raises(publishing.ReleaseStopped, match="after"):
        publishing.gated_release(lambda: checks(True), lambda: done.append(1), lambda: checks(False))
    assert done == [1] and publishing.gated_release(lambda: checks(True), lambda: None, lambda: checks(True)) == {"before": 1, "after": 1}


def test_export_is_in_order_and_survives_quotes(spark, tmp_path):
    from quillon.operators import publishing

    rows = [(1, 'A "B", Inc', "multi_family_office", "qualifying", "a@x.org", "B", 50, ["e", "r"]), (2, "Z", "single_family_office", "qualifying", None, None, 99, []), (3, "Y", "multi_family_office", "qualifying", "p@x.org", "PUB", 10, ["e"])]
    records = spark.createDataFrame([(*r, "d.org", "NY") for r in rows], "crd long, name string, category string, release_state string, email string, grade string, completion int, sectors array<string>, domain string, state string")
    signals = spark.createDataFrame([(1, "deal", "2026-01-02", "x" * 100), (1, "hire", "2025-01-02", "y")], "crd long, type string, date string, description string")
    paths = publishing.export(records, signals, f"file://{tmp_path}")
    got = publishing.read_surface(spark, paths["family_offices"], publishing.PRODUCT_COLUMNS).withColumn("f", F.input_file_name()).orderBy("f", F.monotonically_increasing_id()).collect()
    assert [r.CRD for r in got] == ["3", "1", "2"] and got[1]["Family Office Name"] == 'A "B", Inc' and got[1]["Investing Sectors"] == "e; r"
    assert got[1]["Recent Signals"] == f"2 signal(s); latest 2026-01-02 (deal): {'x' * 80}" and got[2]["Recent Signals"] == "no recent signal found"


def test_tool_loop_runs_out_of_steps():
    from quillon.operators import answers

    answer, log = answers.run_tools(lambda seen: {"tool": "t", "args": {"n": len(seen)}}, {"t": lambda a: a}, steps=3)
    assert answer is None and [e["status"] for e in log] == ["ok", "ok", "ok", "out of steps"]


def test_frontier_operators_on_empty_tables(spark):
    from quillon.operators import frontier

    none = lambda shape: spark.createDataFrame([], shape)
    assert frontier.fetched(none("url string, attempt int, status int, insecure boolean, retry_after int")).count() == 0
    assert frontier.page_bundles(none("key string, url string, id long, text string")).count() == 0
    assert frontier.crawl_frontier(none("key string, name string, website string, tier string, reasons string, raum long"), 5).count() == 0
    hosts = spark.createDataFrame([(["MX.Google.com"],), ([],), (None,)], "h array<string>")
    assert [r[0] for r in hosts.select(frontier.provider(F.col("h"))).collect()] == ["google", "other", "other"]
