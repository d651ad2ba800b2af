"""The queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from quillon.llm import registry


@pytest.mark.parametrize("name", sorted(registry.expected_sql()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, name, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/{sf}/{t}.parquet'")
    cur = con.execute(registry.expected_sql()[name])
    columns = [d[0] for d in cur.description]
    got = registry.queries()[name](spark, f"/root/testdata/{sf}").select(*columns)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, cur.fetchall()))
