"""Every query with SQL, against DuckDB on the smallest tables, where these are there."""

import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("CADENZA_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        path = f"{SF}/{f}" if os.path.isfile(f"{SF}/{f}") else f"{SF}/{f}/*.parquet"
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{path}')")
    return c


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    value = lambda x: None if x is None else "nan" if x != x else float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted(repr(tuple(value(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == canon(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
