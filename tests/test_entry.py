import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tilewright.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(rows):
    return sorted(repr([round(float(v), 6) + 0.0 if isinstance(v, float) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = entry.queries()[name](spark, SF), con.sql(entry.oracle_sql()[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert canon(got.select(*order).collect()) == canon(want.select(*order).fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_corpus_operators(monkeypatch):
    import importlib

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("tilewright.llm")] + ["corpus_pipeline", "tilewright.llm", "tilewright.llm.queries"]:
        monkeypatch.setitem(sys.modules, name, None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    alone = importlib.import_module("__spark_entry__")
    assert {*alone.queries()} == {*catalog.queries()}
    monkeypatch.delitem(sys.modules, "__spark_entry__")
