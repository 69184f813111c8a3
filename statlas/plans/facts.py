"""Views of the driver's star schema as country-year facts.

A nation is a country, a region its regime bucket, the year of an order the year. Measures are
population (customers who ordered), gdp (order value) and gdp per head.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POPULATION, GDP, PER_HEAD = "chronicle.population", "chronicle.gdp", "chronicle.gdp_per_capita"


def money() -> Column:
    """Order values as decimals: totals do not depend on the order of rows."""
    return F.col("o_totalprice").cast("decimal(18,2)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 rows: nations with their regime labels."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return joined.select("n_nationkey", F.col("n_name").alias("country_iso3"), F.col("r_name").alias("political_regime_bucket"), F.concat(F.lit("regime "), F.col("n_nationkey") % 4).alias("political_regime"))


def in_years(orders: DataFrame, years: tuple[int | None, int | None]) -> DataFrame:
    """orders of the years from the first to the last (None: open), as a range of dates that the scan can use."""
    first, last = years
    if first is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(datetime(first, 1, 1)))
    if last is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(datetime(last + 1, 1, 1)))
    return orders


def country_years(spark: SparkSession, sf_dir: str, years: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """One row per country and year: population and gdp. Orders are summed by customer before they meet the countries."""
    orders = in_years(table(spark, sf_dir, "orders"), years).groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.sum(money()).alias("spent"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # a row per customer and year is left, so population is a plain count
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    sums = joined.groupBy("c_nationkey", "year").agg(F.count("*").cast("double").alias("population"), F.sum("spent").cast("double").alias("gdp"))
    return sums.join(F.broadcast(countries(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey")).drop("c_nationkey", "n_nationkey")


def fact(spark: SparkSession, sf_dir: str, years: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """The long metric fact: a row per metric, country and year, of the years asked for."""
    wide = country_years(spark, sf_dir, years).withColumn("per_head", F.col("gdp") / F.col("population"))
    long = wide.unpivot(["country_iso3", "political_regime_bucket", "political_regime", "year"], ["population", "gdp", "per_head"], "measure", "value")
    metric = F.when(F.col("measure") == "population", POPULATION).when(F.col("measure") == "gdp", GDP).otherwise(PER_HEAD)
    return long.select(
        metric.alias("metric_id"),
        F.lit("").alias("metric_unit"),
        F.lit("orders").alias("metric_source"),
        F.lit("sum").alias("metric_method"),
        F.make_date("year", F.lit(1), F.lit(1)).alias("year_date"),
        "year",
        "country_iso3",
        F.initcap(F.lower("country_iso3")).alias("country_name"),
        "political_regime",
        "political_regime_bucket",
        F.lit("exists").alias("existence_status"),
        "value",
    )


def customer_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse series: (key, year, value, n) of each customer's orders, with real gaps."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("year")).agg(F.sum(money()).cast("double").alias("value"), F.count("*").alias("n"))
