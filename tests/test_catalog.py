"""Every registered query of the engine against its DuckDB oracle, and the entry points."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__
from statlas.plans import catalog, source_catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck() -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return connection


def cell(x: object) -> str:
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, bool) or not isinstance(x, int | float):
        return str(x)
    return repr(float(x))


def rows(columns: list[str], found: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(cell(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    wanted = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    assert rows(df.columns, got) == rows(wanted.columns, wanted.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_component_rows_at_ties(spark):
    """The larger tables have contributions at a tie of the last digit."""
    data = DATA.replace("sf0.001", "sf0.01")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW orders AS SELECT * FROM '{data}/orders.parquet'")
    df = source_catalog.component_rows(spark, data)
    wanted = duck.sql(__spark_entry__.oracle_sql()["component_rows"])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(wanted.columns, wanted.fetchall())
