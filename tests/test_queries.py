"""Every registered query with SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from labelmill.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return connection


def _norm(value):
    return round(value, 9) if isinstance(value, float) else value


def _sorted(rows, columns):
    return sorted((tuple(_norm(row[c]) for c in columns) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, sf, con, name):
    df = registry.QUERIES[name](spark, sf)
    cursor = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    columns = sorted(names)
    want = [dict(zip(names, row)) for row in cursor.fetchall()]
    assert _sorted(df.collect(), columns) == _sorted(want, columns)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
