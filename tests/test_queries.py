from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
TABLES = ("bank", "clean", "documents", "eval_items", "tag_vocab", "task_increment", "tasks")


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_against_sql(spark, name):
    df = entry.queries()[name](spark, str(DATA))
    got = [tuple(r) for r in df.select(sorted(df.columns)).collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(set(df.columns)) == len(df.columns)
        pytest.skip("no SQL: runs, and is held against brute force elsewhere")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    assert sorted(df.columns) == sorted(names)
    want = [tuple(row[i] for i in order) for row in rel.fetchall()]
    near = lambda rows: sorted(([round(x, 9) if isinstance(x, float) else x for x in r] for r in rows), key=repr)
    assert near(got) == near(want)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
