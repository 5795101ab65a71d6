"""Every registered query against its SQL, and the inventory against the queries."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from registry import COVERAGE, ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "conversations", "labels", "benchmark", "events", "orders", "lineitem")
INVENTORY = {
    "S": 11, "P": 12, "J": 6, "A": 32, "W": 5, "O": 5, "U": 4, "F": 15, "B": 10, "T": 6, "C": 13, "L": 3,
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if v is None or v != v else v for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def test_every_operator_has_a_query():
    covered = {i for ids in COVERAGE.values() for i in ids}
    assert covered == {f"{family}{i}" for family, n in INVENTORY.items() for i in range(1, n + 1)}
    assert set(COVERAGE) == set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert QUERIES.keys() <= entry_points.queries().keys() and ORACLE.keys() <= entry_points.oracle_sql().keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
