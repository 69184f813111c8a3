"""Growth, regime and latest-value tables over the long metric fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlas.functions.scalars import cagr_pct, decade, pct_growth
from statlas.operators.joins import require_columns
from statlas.plans.facts import GDP, PER_HEAD, POPULATION

CONTINUITY = ("country_iso3", "metric_id", "metric_unit", "metric_source", "metric_method")
FACT = ("metric_id", "year", "year_date", "country_iso3", "country_name", "political_regime", "political_regime_bucket", "existence_status", "value")
SHORT = {POPULATION: "population", GDP: "gdp", PER_HEAD: "gdp_per_capita"}


def with_optional(fact: DataFrame) -> DataFrame:
    """metric_unit, metric_source and metric_method, empty where they are missing or null."""
    return fact.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in fact.columns else F.lit("") for c in CONTINUITY[2:]})


def country_year_growth(fact: DataFrame) -> DataFrame:
    """Change against the year before within a series of one unit, source and method; a gap of years breaks it."""
    require_columns(fact, FACT)
    order = Window.partitionBy(*CONTINUITY).orderBy("year")
    df = with_optional(fact).withColumn("_before", F.lag("value").over(order)).withColumn("_gap", F.col("year") - F.lag("year").over(order))
    before = F.when(F.col("_gap") == 1, F.col("_before"))
    return df.withColumns(
        {
            "prev_value": before,
            "yoy_abs_change": F.col("value") - before,
            "yoy_pct_growth": pct_growth(F.col("value"), before),
            "decade": decade(F.col("year")),
        }
    ).drop("_before", "_gap")


def regime_year_aggregates(fact: DataFrame, growth: DataFrame | None = None, one_population: bool = False) -> DataFrame:
    """Aggregates by year and metric at two granularities: regime buckets (regime empty) and regimes (bucket empty).

    Both come from one expansion of the rows. Growth and each country's population of the year, the weight, are windows
    within a country, so the fact is exchanged once for both. If a country has several population rows a year, its
    rows count that often, unless one_population takes their maximum. growth: country_year_growth(fact), if it is there already.
    """
    rows = country_year_growth(fact.repartition("country_iso3")) if growth is None else with_optional(growth)
    year = Window.partitionBy("country_iso3", "year")
    own = F.when(F.col("metric_id") == POPULATION, F.col("value"))
    people = (F.max if one_population else F.sum)(own).over(year)
    times = F.lit(1) if one_population else F.greatest(F.count(own).over(year), F.lit(1))
    work = rows.withColumns({"_people": people, "_times": times}).where(F.col("value").isNotNull())
    level = F.explode(F.array(F.struct(F.lit(True).alias("bucket"), F.col("political_regime_bucket").alias("name")), F.struct(F.lit(False).alias("bucket"), F.col("political_regime").alias("name"))))
    keys = ["year", "metric_id", "metric_unit", "is_bucket", "name"]
    work = work.select("year", "metric_id", "metric_unit", "country_iso3", "value", "_people", "_times", "yoy_pct_growth", level.alias("_l")).select("*", F.col("_l.bucket").alias("is_bucket"), F.col("_l.name").alias("name"))
    # by country first, so that countries are counted without a distinct
    parts = work.groupBy(*keys, "country_iso3").agg(
        F.sum("_times").alias("_n"),
        F.sum(F.col("value") * F.col("_times")).alias("_sum"),
        F.sum(F.col("value") * F.coalesce("_people", F.lit(0.0))).alias("_weighted"),
        F.sum("_people").alias("_weight"),
        F.sum(F.when(F.col("name").isNotNull(), F.col("yoy_pct_growth"))).alias("_yoy"),
        F.count(F.when(F.col("name").isNotNull(), F.col("yoy_pct_growth"))).alias("_n_yoy"),
    )
    n_yoy = F.sum("_n_yoy")
    out = parts.groupBy(*keys).agg(
        F.count("country_iso3").alias("n_countries"),
        (F.sum("_sum") / F.sum("_n")).alias("mean_value"),
        F.sum("_sum").alias("sum_value"),
        F.sum("_weighted").alias("_weighted"),
        F.sum("_weight").alias("_weight"),
        F.when(n_yoy > 0, F.sum("_yoy") / n_yoy).alias("mean_yoy_pct_growth"),
    )
    order = Window.partitionBy("metric_id", "metric_unit", "is_bucket", "name").orderBy("year")
    out = out.withColumn("prev_mean_value", F.lag("mean_value").over(order))
    return out.select(
        "year",
        "metric_id",
        "metric_unit",
        F.when(F.col("is_bucket"), F.col("name")).otherwise("").alias("political_regime_bucket"),
        F.when(F.col("is_bucket"), "").otherwise(F.col("name")).alias("political_regime"),
        "n_countries",
        "mean_value",
        "sum_value",
        F.when(F.col("_weight") > 0, F.col("_weighted") / F.col("_weight")).alias("pop_weighted_mean_value"),
        "mean_yoy_pct_growth",
        "prev_mean_value",
    )


def latest_by(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """The latest year of each key and the value there (ties: the smallest value), without a sort."""
    best = F.max(F.struct(F.col("year"), (-F.col(value)).alias("_v")))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.year").alias("year"), (-F.col("_b._v")).alias(value))


def cagr(fact: DataFrame, keys: Sequence[str] = ("country_iso3", "metric_id"), years: int = 10) -> DataFrame:
    """Compound growth over exactly so many years up to each key's latest year; null if that start has no value."""
    rows = fact.where(F.col("value").isNotNull()).groupBy(*keys, "year").agg(F.min("value").alias("value"))
    end = latest_by(rows, keys).select(*keys, F.col("year").alias("end_year"), F.col("value").alias("end_value"))
    start = rows.select(*keys, (F.col("year") + years).alias("end_year"), F.col("value").alias("start_value"))
    both = end.join(start, [*keys, "end_year"], "left")
    return both.select(*keys, "end_year", "start_value", "end_value", cagr_pct(F.col("start_value"), F.col("end_value"), F.lit(float(years))).alias("cagr_pct"))


def min_rank(x: Column, *partition: str) -> Column:
    """Competition rank from the largest down; null stays null."""
    w = Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))
    return F.when(x.isNotNull(), F.rank().over(w.orderBy(x.desc_nulls_last())))


def country_latest_metrics(fact: DataFrame, years: int = 10) -> DataFrame:
    """A row per country: each metric's latest value and year, ranks, growth over so many years, and the last known labels.

    One row per country is left when the ranks are taken, so their single partition is small.
    """
    require_columns(fact, FACT)
    rows = fact.where(F.col("value").isNotNull())
    labels = ("country_name", "political_regime", "political_regime_bucket", "existence_status")
    cells = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("year", c))).alias(c) for c in labels]
    for metric, name in SHORT.items():
        own = F.col("metric_id") == metric
        cells += [F.max(F.when(own, F.struct("year", (-F.col("value")).alias("v")))).alias(f"_{name}"), F.collect_list(F.when(own, F.struct("year", "value"))).alias(f"_{name}_series")]
    wide = rows.groupBy("country_iso3").agg(*cells)  # a country's series is a value a year

    def latest(name: str) -> list[Column]:
        end, value = F.col(f"_{name}.year"), -F.col(f"_{name}.v")
        start = F.array_min(F.transform(F.filter(f"_{name}_series", lambda s: s["year"] == end - years), lambda s: s["value"]))
        return [value.alias(f"latest_{name}"), end.alias(f"{name}_latest_year"), cagr_pct(start, value, F.lit(float(years))).alias(f"{name}_{years}yr_cagr_pct")]

    out = wide.select("country_iso3", *(c for name in SHORT.values() for c in latest(name)), *labels)
    out = out.withColumn("latest_year", F.greatest(*(F.col(f"{name}_latest_year") for name in SHORT.values())))
    return out.withColumns({f"{name}_rank": min_rank(F.col(f"latest_{name}")) for name in SHORT.values()})
