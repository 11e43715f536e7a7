"""Every registered query against its SQL oracle (DuckDB), exact values."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from candela.plans.catalog import registry  # noqa: E402
from candela.plans.oracle import build  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402
from conftest import SF001  # noqa: E402

# the library's own queries; those of an add-on are tested beside it
QUERIES, SQL = registry(), build()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(SQL[name])
    want, want_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["ticker", "pct_tecnico_buy", "pct_fundamental_buy", "decision_final"]
