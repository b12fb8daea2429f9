"""The surfaces are one partition of all held records, and each check over them fails where it should."""

import pytest
from pyspark.sql import functions as F

from quillon.operators import publishing

SHAPE = "crd long, name string, domain string, state string, release_state string, category string, grade string, email string, completion int, sectors array<string>"
OFFICE, PRACTICE = "single_family_office", "embedded_fo_practice"
FIRMS = [
    (1, "qualifying", OFFICE, "A", "a@x.com", 50), (2, "qualifying", OFFICE, "PUB", None, 10), (3, "qualifying", PRACTICE, None, None, 90), (4, "unresolved", OFFICE, None, None, 0), (5, "unresolved", "wealth_manager", None, None, 0),
    (6, "quarantined", None, None, None, 0), (7, "unresolved", None, None, None, 0), (8, None, "not_fo", None, None, 0), (9, "qualifying", OFFICE, "A", "b@x.com", 70),
]


def records(spark, firms):
    return spark.createDataFrame([(i, f'Firm "{i}", Inc', f"{i}.com", "TX", state, category, grade, email, done, ["energy", "real; estate"]) for i, state, category, grade, email, done in firms], SHAPE)


@pytest.fixture(scope="module")
def shipped(spark, tmp_path_factory):
    rows = records(spark, FIRMS)
    signals = spark.createDataFrame([(1, "hire", "2024-05", "x" * 100), (1, "move", "2023", "y")], "crd long, type string, date string, description string")
    paths = publishing.export(rows, signals, f"file://{tmp_path_factory.mktemp('out')}")
    return {n: publishing.read_surface(spark, paths[n], columns).cache() for n, (_, columns, _) in publishing.surfaces(rows).items()}


def failed(spark, shipped, firms=FIRMS, audit=(), found=(1, 2, 3, 4, 7, 9)):
    frames = [spark.createDataFrame([(x,) for x in xs], t) for xs, t in ((audit, "email string"), (found, "crd long"))]
    return {r.check for r in publishing.surface_checks(records(spark, firms), shipped, *frames).collect() if not r.ok}


def test_every_record_is_on_one_surface_in_order(spark, shipped):
    assert {n: [int(r.CRD) for r in df.select("CRD").collect()] for n, df in shipped.items()} == {
        "family_offices": [2, 9, 1], "practices": [3], "pending_decision_maker": [4], "reclassified": [8, 5], "quarantined": [6], "awaiting_adjudication": [7]}
    said = {r.CRD: r["Recent Signals"] for r in shipped["family_offices"].collect()}
    assert said["1"] == f"2 signal(s); latest 2024-05 (hire): {'x' * 80}" and said["9"] == "no recent signal found"
    assert shipped["family_offices"].first()["Family Office Name"] == 'Firm "2", Inc'


def test_each_check_fails_where_it_should(spark, shipped):
    assert failed(spark, shipped) == set()
    whole = {"the surfaces partition all held records"}
    for name, df in shipped.items():
        more = {"qualifying records are the offices and practices"} if name in ("family_offices", "practices") else set()
        assert failed(spark, shipped | {name: df.limit(0)}) == whole | more | {f"{name} as shipped are those held"}
    told = lambda name, **columns: failed(spark, shipped | {name: shipped[name].withColumns({c: F.lit(v) for c, v in columns.items()})})
    assert told("family_offices", **{"Entity Category": "bank"}) == {"the product has offices only"}
    assert told("reclassified", **{"Entity Category": OFFICE}) == {"reclassified firms are no offices"}
    assert told("family_offices", **{"Primary Email Grade": "D", "Primary Email": "z@x.com"}) == {"no rejected grade was shipped"}
    assert failed(spark, shipped, audit=["B@x.com"]) == {"no rejected address was shipped"}
    assert failed(spark, shipped, found=(1, 2, 9, 6)) == {"quarantined firms cannot be retrieved"}
    assert failed(spark, shipped, found=(1, 2, 9, 5)) == {"reclassified firms cannot be retrieved"}
    assert failed(spark, shipped, found=(1, 9)) == {"qualifying offices can be retrieved"}
    bank = [*FIRMS, (10, "qualifying", "bank", None, None, 0)]  # a record that nothing was shipped of
    assert failed(spark, shipped, firms=bank) == whole | {"family_offices as shipped are those held", "qualifying records are the offices and practices"}
