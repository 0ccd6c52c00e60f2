"""The driver's correctness gate, locally: every query against its DuckDB SQL (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    """All of the library's queries; the training-data queries may go without (SQL cannot express most)."""
    from areacube.plans import registry
    assert set(registry.queries()) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["Jaar", "geolevel", "geoitem", "JG_Geslacht", "JG_Lftklasse"]


def test_p_value_rows(spark):
    df = QUERIES["svy_p_value"](spark, SF_SMALL)
    ps = [r.p for r in df.collect()]
    assert ps and all(p is None or 0.0 <= p <= 1.0 for p in ps)
