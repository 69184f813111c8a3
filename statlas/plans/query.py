"""Compile a semantic query into one lazy DataFrame: filters reach the scan, aggregates are combined before the exchange."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlas.functions.scalars import mapped
from statlas.operators.joins import require_columns
from statlas.plans.spec import METRICS, Filter, Query, Transform, validated

#: Columns that a series of one metric is followed by.
SERIES = ("metric_id", "country_iso3")


def condition(f: Filter) -> Column:
    c = F.col(f.field)
    return {"eq": lambda: c == f.value, "in": lambda: c.isin(list(f.value)), "gte": lambda: c >= f.value, "lte": lambda: c <= f.value}[f.operator]()


def years_of(query: Query) -> tuple[int | None, int | None]:
    """The first and last year that a query asks for, by its time range and its filters of year; None where it is open."""
    low = [f.value for f in query.filters if f.field == "year" and f.operator in ("eq", "gte")]
    high = [f.value for f in query.filters if f.field == "year" and f.operator in ("eq", "lte")]
    if query.time_range is not None:
        low.append(query.time_range[0])
        high.append(query.time_range[1])
    return max(low, default=None), min(high, default=None)


def labelled(df: DataFrame) -> DataFrame:
    """metric_label and value_unit, empty for metrics that are not registered."""
    labels, units = ({k: getattr(m, a) for k, m in METRICS.items()} for a in ("label", "unit"))
    return df.withColumns({"metric_label": mapped(F.col("metric_id"), labels, ""), "value_unit": mapped(F.col("metric_id"), units, "")})


def selected(fact: DataFrame, query: Query) -> DataFrame:
    require_columns(fact, ["metric_id", "value", *(["year"] if query.time_range else []), *(f.field for f in query.filters)])
    parts = [F.col("metric_id").isin(list(query.metric_ids)), *(condition(f) for f in query.filters)]
    if query.time_range is not None:
        parts.append(F.col("year").between(*query.time_range))
    return fact.where(reduce(lambda a, b: a & b, parts))


def transformed(df: DataFrame, t: Transform, series: tuple[str, ...] = SERIES) -> DataFrame:
    """value replaced along each series by year. Gaps: a change needs the year before; other kinds go by position."""
    by = Window.partitionBy(*series)
    order = by.orderBy("year")
    value = F.col("value")
    if t.kind == "rolling_mean":
        new = F.avg(value).over(order.rowsBetween(1 - t.window, 0))
    elif t.kind == "year_over_year_change":
        new = F.when(F.col("year") - F.lag("year").over(order) == 1, value - F.lag(value).over(order))
    elif t.kind == "index_to_base_year":
        base = F.max(F.when(F.col("year") == t.base_year, value)).over(by)
        new = F.when(base != 0, value / base * 100)
    elif t.kind == "log10":
        new = F.when(value > 0, F.log10(value))
    elif t.kind == "min_max_normalize":
        # an aggregate that combines before the exchange: a window would put a whole metric into one task
        ends = df.groupBy("metric_id").agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
        df = df.join(ends, "metric_id")
        new = F.when(F.col("_high") > F.col("_low"), (value - F.col("_low")) / (F.col("_high") - F.col("_low")))
    else:
        new = value
    if t.metric_ids:
        new = F.when(F.col("metric_id").isin(list(t.metric_ids)), new).otherwise(value)
    return df.withColumn("value", new).drop("_low", "_high")


def with_weights(fact: DataFrame, query: Query) -> DataFrame:
    """fact's rows of the query's metrics and its weights, with the weight of their country and year: one pass, no join."""
    rows = fact.where(F.col("metric_id").isin([*query.metric_ids, query.weight_metric_id]))
    own = F.when(F.col("metric_id") == query.weight_metric_id, F.col("value"))
    return rows.withColumn("_w", F.max(own).over(Window.partitionBy("country_iso3", "year")))


def weighted(df: DataFrame, query: Query) -> DataFrame:
    both = df.where(F.col("value").isNotNull() & F.col("_w").isNotNull())
    total = F.sum("_w")
    return both.groupBy(*query.group_by, "metric_id").agg(F.when(total != 0, F.sum(F.col("value") * F.col("_w")) / total).alias("value"))


def execute(query: Query, fact: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of fact for query: filtered, transformed, aggregated and labelled.

    strict keeps to what metrics allow; otherwise the whole vocabulary runs. Null keys form groups of their own; a sum of
    nulls alone is 0, other aggregates of nulls alone are null; count counts rows.
    """
    validated(query, strict)
    df = selected(with_weights(fact, query) if query.aggregation == "weighted_mean" else fact, query)
    for t in query.transforms:
        df = transformed(df, t)
    require_columns(df, list(query.group_by))
    kinds = {
        "count": lambda: F.count("*").cast("double"),
        "sum": lambda: F.coalesce(F.sum("value"), F.lit(0.0)),
        "mean": lambda: F.avg("value"),
        "median": lambda: F.percentile("value", F.lit(0.5)),
        "min": lambda: F.min("value"),
        "max": lambda: F.max("value"),
    }
    if query.aggregation == "none":
        return labelled(df)
    if query.aggregation == "weighted_mean":
        out = weighted(df, query)
    else:
        out = df.groupBy(*query.group_by, "metric_id").agg(kinds[query.aggregation]().alias("value"))
    return labelled(out.withColumn("aggregation", F.lit(query.aggregation)))
