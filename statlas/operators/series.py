"""Annual series with gaps: interpolation, carry-forward, bracketing, unambiguous values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the longest span between known years that is interpolated.
MAX_SPAN = 75


def yearly(df: DataFrame, keys: Sequence[str], first: int | None = None, last: int | None = None) -> DataFrame:
    """A row for every year between each key's first and last (or the given ones), values null where there was none."""
    low = F.min("year") if first is None else F.lit(first)
    high = F.max("year") if last is None else F.lit(last)
    years = df.groupBy(*keys).agg(F.sequence(low, high).alias("_y")).select(*keys, F.explode("_y").alias("year"))
    return years.join(df, [*keys, "year"], "left")


def neighbours(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """df with _prev and _next: (year, value) of the nearest known years on either side."""
    order = Window.partitionBy(*keys).orderBy("year")
    known = F.when(F.col(value).isNotNull(), F.struct("year", value))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    return df.withColumns({"_prev": F.last(known, ignorenulls=True).over(before), "_next": F.first(known, ignorenulls=True).over(after)})


def filled(df: DataFrame, keys: Sequence[str], value: str = "value", max_span: int = MAX_SPAN, max_lag: int = 1) -> DataFrame:
    """value exact, else interpolated between neighbours at most max_span apart, else carried forward at most max_lag years; method names it."""
    both = neighbours(df, keys, value)
    p, n, year = F.col("_prev"), F.col("_next"), F.col("year")
    span = n["year"] - p["year"]
    line = F.when((span > 0) & (span <= max_span), p[value] + (n[value] - p[value]) * (year - p["year"]) / span)
    carried = F.when(year - p["year"] <= max_lag, p[value])
    exact = F.col(value)
    method = F.when(exact.isNotNull(), "exact").when(line.isNotNull(), "interpolated").when(carried.isNotNull(), "proxy").otherwise("missing")
    return both.withColumns({"method": method, "filled": F.coalesce(exact, line, carried)}).drop("_prev", "_next")


def carried_forward(df: DataFrame, keys: Sequence[str], value: str = "value", max_lag: int = 1) -> DataFrame:
    p = F.col("_prev")
    out = neighbours(df, keys, value).withColumn("carried", F.coalesce(F.col(value), F.when(F.col("year") - p["year"] <= max_lag, p[value])))
    return out.drop("_prev", "_next")


def bracketed(df: DataFrame, keys: Sequence[str], value: str, code: float = 0) -> DataFrame:
    """bracketed: the value is missing and the nearest known ones on both sides are code."""
    both = neighbours(df, keys, value)
    hit = F.col(value).isNull() & (F.col("_prev")[value] == code) & (F.col("_next")[value] == code)
    return both.withColumn("bracketed", F.coalesce(hit, F.lit(False))).drop("_prev", "_next")


def only_value(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """resolved: the row's own value, else the key's only distinct value, else null."""
    by = Window.partitionBy(*keys)
    alone = F.when(F.min(value).over(by) == F.max(value).over(by), F.min(value).over(by))
    return df.withColumn("resolved", F.coalesce(value, alone))


def population_units(absolute: Column, thousands: Column, tens_of_thousands: Column) -> Column:
    return F.coalesce(absolute, thousands * 1000, tens_of_thousands * 10000)
