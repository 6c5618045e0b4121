"""Every registered query of the engine's own operators against its SQL in DuckDB."""

import os

import duckdb
import pytest

from genoloom.plans import registry

SF = "/root/testdata/sf0.001"


def normal(v):
    if isinstance(v, float):
        return "nan" if v != v else float(f"{v:.9g}")
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str([normal(v) for v in r]) for r in df.select(*columns).collect())
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    assert got == sorted(str([normal(v) for v in r]) for r in want.select(*columns).fetchall())
    assert got


def test_entry_survives_without_the_optional_package(monkeypatch):
    import sys

    import __spark_entry__ as entry

    for gone in ("corpus_pipeline", "genoloom.llm"):
        with monkeypatch.context() as m:
            m.setitem(sys.modules, gone, None)
            m.delitem(sys.modules, "corpus_pipeline" if gone != "corpus_pipeline" else "genoloom.llm.queries", raising=False)
            assert set(entry.queries()) == set(registry.QUERIES) and set(entry.oracle_sql()) == set(registry.ORACLE_SQL)
