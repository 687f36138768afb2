"""Every catalogue query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from platelake.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(x):
    if x is None or (isinstance(x, float) and x != x):
        return "-"
    return f"{x:.6g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    if name not in ORACLES:
        assert got
        return
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == sorted(df.columns)
    want = rel.project(", ".join(f'"{c}"' for c in sorted(rel.columns))).fetchall()
    assert sorted(map(lambda r: tuple(map(cell, r)), got)) == sorted(map(lambda r: tuple(map(cell, r)), want))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "Bioactive" and df.count() > 0
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
