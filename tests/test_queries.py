"""Differential test: every registered query against its oracle SQL in DuckDB, and the
driver repeats it at sf0.01."""

import duckdb
import pytest

import __spark_entry__ as E
from gleanspark.sources.tables import TABLES
from querybook.more import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_oracle():
    """Of the capture pipelines; the training-data queries are tested in tests/llm."""
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert r["ok"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "value_score" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_types_match_oracle(spark, con, name):
    from tools.type_check import SPARK_TO_DUCK
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in E.queries()[name](spark, SF_SMALL).schema.fields}
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert s == d
