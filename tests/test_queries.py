"""Every registered query against its reference SQL, on the smallest tables."""

import math

import duckdb
import pytest

from docframe.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(cell(r[i]) for i in order) for r in data), key=str)


def test_every_sql_belongs_to_a_query():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    got = rows(df.columns, df.collect())
    if name in catalog.oracle_sql():
        cur = con.execute(catalog.oracle_sql()[name])
        assert got == rows([x[0] for x in cur.description], cur.fetchall())
    else:
        assert got[1]
