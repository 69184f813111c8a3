"""Spells and periods: joins of years with intervals, by exploding an interval's years into equality keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def years_of(spells: DataFrame, start: str, end: str, first: int, last: int) -> DataFrame:
    """A row per year that a spell touches, within first..last; spells with an open start are left out, an open end runs on."""
    low = F.greatest(F.year(start), F.lit(first))
    high = F.least(F.coalesce(F.year(end), F.lit(last)), F.lit(last))
    return spells.where(F.col(start).isNotNull() & (low <= high)).withColumn("year", F.explode(F.sequence(low, high)))


def stab_earliest(spells: DataFrame, keys: Sequence[str], start: str, end: str, value: str, first: int, last: int) -> DataFrame:
    """For each key and year the value of the earliest spell that touches it (ties: the smallest value), and how many do."""
    touched = years_of(spells, start, end, first, last)
    best = F.min(F.struct(F.col(start), F.col(value))).alias("_b")
    return touched.groupBy(*keys, "year").agg(best, F.count("*").alias("n_spells")).select(*keys, "year", F.col(f"_b.{value}").alias(value), F.col(f"_b.{start}").alias(start), "n_spells")


def overlap_longest(spells: DataFrame, keys: Sequence[str], start: str, end: str, value: str, first: int, last: int) -> DataFrame:
    """For each key and year the value that covers most days (ties: earliest start, smallest value), and whether several do."""
    touched = years_of(spells, start, end, first, last)
    begin = F.greatest(F.to_date(start), F.make_date("year", F.lit(1), F.lit(1)))
    stop = F.least(F.coalesce(F.to_date(end), F.make_date("year", F.lit(12), F.lit(31))), F.make_date("year", F.lit(12), F.lit(31)))
    days = touched.withColumn("days", F.datediff(stop, begin) + 1).where("days > 0")
    best = F.min(F.struct((-F.col("days")).alias("_d"), F.col(start), F.col(value))).alias("_b")
    out = days.groupBy(*keys, "year").agg(best, (F.min(value) != F.max(value)).alias("several"))
    return out.select(*keys, "year", F.col(f"_b.{value}").alias(value), (-F.col("_b._d")).alias("days"), "several")


def period_value(targets: DataFrame, periods: DataFrame, keys: Sequence[str], start: str, end: str, value: str) -> DataFrame:
    """value of the period (whole years start..end) that holds a target's year: smallest end, then largest start.

    A year after the last year of all periods takes its key's latest period, as a proxy; a gap gives null.
    """
    last = periods.agg(F.max(end).alias("_last"))
    pick = F.min(F.struct(F.col(end).alias("_e"), (-F.col(start)).alias("_s"), F.col(value).alias("_v")))
    by_year = periods.withColumn("year", F.explode(F.sequence(start, end))).groupBy(*keys, "year").agg(pick.alias("_hit"))
    late = periods.groupBy(*keys).agg(F.max(F.struct(F.col(end).alias("_e"), F.col(start).alias("_s"), F.col(value).alias("_v"))).alias("_late"))
    both = targets.join(by_year, [*keys, "year"], "left").join(late, list(keys), "left").crossJoin(F.broadcast(last))
    proxy = F.col("_hit").isNull() & (F.col("year") > F.col("_last")) & F.col("_late").isNotNull()
    return both.select(*targets.columns, F.when(proxy, F.col("_late._v")).otherwise(F.col("_hit._v")).alias(value), proxy.alias("is_proxy"))


def split_by_period(rows: DataFrame, mapping: DataFrame, code: str, start: str, end: str) -> DataFrame:
    """rows (code, start..end) with each target of mapping (code, target, first_year, last_year) whose years meet theirs; several may."""
    m = F.broadcast(mapping.withColumnRenamed(code, "_code"))
    meets = (F.col(code) == F.col("_code")) & (F.col(start) <= F.coalesce("last_year", F.lit(9999))) & (F.col(end) >= F.col("first_year"))
    return rows.join(m, meets).select(*rows.columns, "target", F.greatest(start, "first_year").alias("from_year"), F.least(F.col(end), F.coalesce("last_year", F.col(end))).alias("to_year"))


def first_hit(df: DataFrame, rules: DataFrame, key: str, year: str = "year", default=None) -> DataFrame:
    """label of the first rule (rank, key, first_year, last_year, label) that holds for a row; default where none does."""
    r = rules.select(F.col("rank"), F.col(key).alias("_k"), "first_year", "last_year", "label")
    hits = df.select(key, year).distinct().join(F.broadcast(r), (F.col(key) == F.col("_k")) & F.col(year).between(F.col("first_year"), F.coalesce("last_year", F.lit(9999))))
    best = hits.groupBy(key, year).agg(F.min_by("label", "rank").alias("label"))
    out = df.join(best, [key, year], "left")
    return out if default is None else out.withColumn("label", F.coalesce("label", default))


