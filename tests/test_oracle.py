"""Every registered query against its SQL twin in a second engine: rows, names, types."""

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_points
from tradevigil.plans import registry

TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES.keys() & entry_points.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    names = [c[0] for c in cursor.description]
    expected = [tuple(dict(zip(names, row))[c] for c in columns) for row in cursor.fetchall()]
    assert sorted(names) == columns
    assert {c: KINDS[t] for c, t in got.dtypes} == types
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert len(rows) == len(expected)
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_every_query_without_sql_is_a_known_one():
    without = set(registry.QUERIES) - set(entry_points.oracle_sql())
    assert without == {"rf_scores", "rf_scores_csv", "rf_run_record", "clear_tables"}


def test_entry_flags_clusters(spark):
    found = entry_points.entry(spark)
    assert found.count() > 0
    assert found.where("connected_clients < 2 OR total_exposure <= 500000000").count() == 0
