"""Every query that has SQL gives the rows DuckDB gives on the same tables."""

from pathlib import Path

import duckdb
import pytest

import quillon.plans  # noqa: F401
from quillon.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations "
          "clicks sales sale_lines clients client_changes vendors items stamps").split()


def duck_tables():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        path = Path(SF, f"{t}.parquet")
        con.sql(f"create view {t} as select * from read_parquet('{path}/*.parquet')" if path.is_dir() else f"create view {t} as select * from read_parquet('{path}')")
    return con


@pytest.fixture(scope="module")
def duck():
    return duck_tables()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(want.columns, want.fetchall())


def test_every_query_without_sql_runs(spark):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, SF).count() > 0, name
