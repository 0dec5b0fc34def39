"""Queries of this part against their SQL."""

import duckdb
import pytest

from snapquarry.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_simhash", "op13_resampling"])
def test_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DATA), db.sql(queries.ORACLE_SQL[name])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
