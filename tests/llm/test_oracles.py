"""The corpus queries that SQL can express, against DuckDB on whole tables."""

from __future__ import annotations

import duckdb
import pytest

from statlas.llm import queries

DATA = "/root/testdata/sf0.001"


def cell(x: object) -> str:
    return "" if x is None else repr(round(float(x), 9)) if isinstance(x, int | float) and not isinstance(x, bool) else str(x)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    wanted = duck.sql(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, DATA).select(*wanted.columns)
    assert sorted(tuple(map(cell, r)) for r in df.collect()) == sorted(tuple(map(cell, r)) for r in wanted.fetchall())


def test_urls_with_links(spark, tmp_path):
    """The URL oracle on pages that do redirect."""
    link = '<html><link href="{}" rel="canonical">'
    rows = [(1, "http://a.net/x", link.format("http://b.net/y")), (2, "http://c.net/", "<meta http-equiv='refresh' content='5; URL=http://b.net/y'>"), (3, "http://d.net/p/q", link.format("/r")), (4, "https://b.net/y", link.format("http://x.com/de/1")), (5, "http://d.net/r", ""), (6, "http://ok.org/", link.format("http://c.net/")), (7, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    wanted = duck.sql(queries.ORACLE_SQL["op10_urls"])
    got = queries.op10_urls(spark, str(tmp_path)).select(*wanted.columns).collect()
    assert sorted(tuple(map(cell, r)) for r in got) == sorted(tuple(map(cell, r)) for r in wanted.fetchall())
    assert {r.page_id for r in got if r.verdict == "block"} == {1, 2, 4}
