"""The queries that SQL can express, against DuckDB on whole tables."""

import duckdb
import pytest

from candela.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = queries.queries()[name](spark, SF)
    columns = sorted(found.columns)
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    key = lambda rows: sorted(str(tuple(r)) for r in rows)
    assert key(found.select(*columns).collect()) == key(tuple(r[i] for i in order) for r in want.fetchall())
