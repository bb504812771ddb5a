"""Registered queries: those with SQL against DuckDB, and the wiring of the contract."""

import importlib
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from labelmill.llm import queries


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        connection.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf, con, name):
    df = queries.QUERIES[name](spark, sf)
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(cursor.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == want


def test_registered():
    assert len([n for n in contract.queries() if n.startswith("op")]) == 13
    assert "pipeline" in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_without_the_subpackage(tmp_path):
    """With the subpackage and the pipeline gone the contract still imports and names the other queries."""
    source = importlib.import_module("__spark_entry__").__file__
    code = (
        "import sys, importlib.util as u\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('labelmill.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        f"spec = u.spec_from_file_location('entry', {source!r}); m = u.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "assert m.queries() and not [n for n in m.queries() if n.startswith('op') or n == 'pipeline']\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=120)
