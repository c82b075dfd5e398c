"""Each registered query of the reference's operators against its SQL in DuckDB at the smallest scale."""

import duckdb
import pytest

from quillgraph.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cell = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(([cell(r[i]) for i in order] for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rows = df.collect()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want = duck.sql(sql)
    assert sorted(want.columns) == sorted(df.columns)
    assert plain(rows, df.columns) == plain(want.fetchall(), want.columns)
