import glob
import os

import duckdb
import pytest

from kinesift.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def rows_of(columns, rows):
    """Rows with columns in order of their names, numbers to five digits, in order."""
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def text(v):
        return "NULL" if v is None or v != v else f"{v:.5f}" if isinstance(v, float) else str(v)

    return sorted(columns), sorted(tuple(text(r[k]) for k in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    if name in SQL:
        c = duck.execute(SQL[name])
        assert got == rows_of([x[0] for x in c.description], c.fetchall())
    else:
        assert len(set(got[0])) == len(got[0]) and (got[1] or name == "p6_found")


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
