"""What the plans of the engine's queries may not hold, and what must reach the scans."""

from __future__ import annotations

import re

import pytest

from statlas.plans import catalog, facts
from statlas.plans.query import execute
from statlas.plans.spec import from_payload

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_no_products(spark, name):
    text = plan(catalog.QUERIES[name](spark, DATA))
    assert not re.search("EvalPython|MapInPandas|MapInArrow|PythonUDF|CartesianProduct", text)


def test_columns_are_pruned(spark):
    text = plan(facts.country_years(spark, DATA))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    orders = next(s for s in scans if "o_custkey" in s)
    assert set(re.findall(r"(\w+):", orders)) == {"o_custkey", "o_totalprice", "o_orderdate"}
    customer = next(s for s in scans if "c_custkey" in s)
    assert set(re.findall(r"(\w+):", customer)) == {"c_custkey", "c_nationkey"}


def test_filters_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    path = str(tmp_path / "fact")
    facts.fact(spark, DATA).write.parquet(path)
    spec = from_payload({"metric": facts.GDP, "time_range": [1996, 1998], "filters": {"political_regime_bucket": "ASIA"}, "aggregation": "sum", "group_by": ["year"]})
    text = plan(execute(spec, spark.read.parquet(path)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: (.*)", text)[1]
    for part in ("EqualTo(metric_id,chronicle.gdp)", "GreaterThanOrEqual(year,1996)", "LessThanOrEqual(year,1998)", "EqualTo(political_regime_bucket,ASIA)"):
        assert part in pushed
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


def test_customers_meet_orders_after_summing(spark):
    """Orders are summed by customer and year before any join, so the exchange carries sums, not orders."""
    text = plan(facts.country_years(spark, DATA))
    assert text.index("SortMergeJoin") < text.index("partial_sum") if "SortMergeJoin" in text else "partial_sum" in text
