"""Every registered query with SQL gives DuckDB's rows; the others run."""

import duckdb
import pytest

from snapquarry import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def told(rows):
    return sorted(([round(v, 6) if isinstance(v, float) else v for v in r] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = [[r[c] for c in columns] for r in df.collect()]
    if name in registry.ORACLE_SQL:
        want = db.sql(registry.ORACLE_SQL[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert told(rows) == told([[r[i] for i in at] for r in want.fetchall()])


def test_directory_entries_of_odd_keys(spark, tmp_path):
    con, name = duckdb.connect(), "directory_entries"
    con.sql("CREATE TABLE customer AS SELECT * FROM (VALUES (1::BIGINT, 7), (1, 2), (1, 2), (2, NULL), (3, NULL), (4, 3), (5, 3), (NULL, 1)) AS t(c_custkey, c_nationkey)")
    con.sql("CREATE TABLE orders AS SELECT * FROM (VALUES (1::BIGINT, 1::BIGINT, 'F'), (1, 1, 'O'), (NULL, 1, 'F'), (NULL, 1, NULL), (2, 2, 'O'), (2, 3, 'F'), (3, 4, 'O'), (4, NULL, 'F')) AS t(o_orderkey, o_custkey, o_orderstatus)")
    for t in ("customer", "orders"):
        con.sql(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
    want = con.sql(registry.ORACLE_SQL[name])
    assert sorted(map(tuple, registry.QUERIES[name](spark, str(tmp_path)).select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
