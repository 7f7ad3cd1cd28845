import os

import pytest

import __spark_entry__ as entry
from keelgraph.plans import registry

SMALL = "/root/testdata/sf0.001"


def test_names_and_sql():
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and set(registry.QUERIES) <= set(names)


def test_core_does_not_know_the_subpackage():
    root = os.path.dirname(os.path.abspath(registry.__file__)) + "/.."
    for folder, _, files in os.walk(root):
        if os.sep + "llm" in folder:
            continue
        for name in files:
            if name.endswith(".py"):
                assert "keelgraph.llm" not in open(os.path.join(folder, name)).read(), name


@pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables")
def test_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS FROM '{SMALL}/{name}'")
    plain = lambda v: tuple(v) if isinstance(v, list) else v
    for name, sql in registry.ORACLE.items():
        df = registry.QUERIES[name](spark, SMALL)
        found = con.execute(sql)
        columns = [c[0] for c in found.description]
        order = [columns.index(c) for c in df.columns]
        expected = sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=str)
        assert sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str) == expected, name
