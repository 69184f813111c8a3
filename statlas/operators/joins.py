"""Lookup joins: overlays, fallback chains, best rows, modes and masks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlas.functions.scalars import plain_name


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")


def top_one(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")


def grid(df: DataFrame, *columns: str) -> DataFrame:
    """Every combination of the columns' distinct values (each a small dimension)."""
    parts = [df.select(c).where(F.col(c).isNotNull()).distinct() for c in columns]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)


def filled_grid(cells: DataFrame, aggregates: DataFrame, keys: Sequence[str], fill: Mapping[str, float]) -> DataFrame:
    return cells.join(aggregates, list(keys), "left").na.fill(dict(fill))


def overlay(base: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """base with cells of cache on top where they are not null; keys that only cache has are added, its other columns are not."""
    shared = [c for c in base.columns if c in cache.columns and c not in keys]
    top = cache.select(*keys, *(F.col(c).alias(f"_{c}") for c in shared))
    both = base.join(top, list(keys), "full")
    return both.select(*(F.coalesce(f"_{c}", c).alias(c) if c in shared else c for c in base.columns))


def merged_dimension(base: DataFrame, curated: DataFrame, keys: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """Two dimensions by key; curated values win where not null; provenance tells where a row comes from."""
    columns = [c for c in curated.columns if c not in keys]
    left = base.withColumn("_in_base", F.lit(True))
    right = curated.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_in_top"))
    both = left.join(right, list(keys), "full")
    values = [F.coalesce(f"_{c}", c).alias(c) if c in base.columns else F.col(f"_{c}").alias(c) for c in columns]
    rest = [c for c in base.columns if c not in columns and c not in keys]
    kind = F.when(F.col("_in_base") & F.col("_in_top"), "merged").when(F.col("_in_base"), names[0]).otherwise(names[1])
    return both.select(*keys, *rest, *values, kind.alias("provenance"))


def preferred_year(targets: DataFrame, rows: DataFrame, keys: Sequence[str], preferred: int, fallback: int, value: str, order: str) -> DataFrame:
    """value at the preferred year, else at the fallback year; the first row by order of each."""
    own = rows.where(F.col("year").isin(preferred, fallback) & F.col(value).isNotNull())
    pick = F.min_by(F.struct(value, "year"), F.struct((F.col("year") != preferred).cast("int"), F.col(order)))
    best = own.groupBy(*keys).agg(pick.alias("_b"))
    return targets.join(best, list(keys), "left").select(*targets.columns, F.col(f"_b.{value}").alias(value), F.col("_b.year").alias("year_used"))


def mode_by(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """The most frequent item of each key (ties: the smallest), its count, and whether there were several."""
    counts = df.where(F.col(item).isNotNull()).groupBy(*keys, item).agg(F.count("*").alias("n"))
    ranked = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("_n"), F.col(item).alias(item))).alias("_b"), F.count("*").alias("_k"))
    return ranked.select(*keys, F.col(f"_b.{item}").alias(item), (-F.col("_b._n")).alias("n"), (F.col("_k") > 1).alias("several"))


def by_priority(df: DataFrame, keys: Sequence[str], column: str, precedence: Sequence[str], *order: Column) -> DataFrame:
    """The row of the highest precedence of each key; other values come last."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, precedence)), F.col(column)), F.lit(0))
    return top_one(df.withColumn("_rank", F.when(rank == 0, len(precedence) + 1).otherwise(rank)), keys, F.col("_rank"), *order).drop("_rank")


def fallback_chain(targets: DataFrame, keys: Sequence[str], sources: Sequence[tuple[str, DataFrame, Column]], value: str) -> DataFrame:
    """value from the first source in order that has one and whose condition on the target holds; source names it, or missing."""
    out = targets
    for i, (_, rows, when) in enumerate(sources):
        out = out.join(rows.select(*keys, F.col(value).alias(f"_v{i}")), list(keys), "left").withColumn(f"_v{i}", F.when(when, F.col(f"_v{i}")))
    found = F.coalesce(*(F.col(f"_v{i}") for i in range(len(sources))))
    name = F.lit("missing")
    for i in reversed(range(len(sources))):
        name = F.when(F.col(f"_v{i}").isNotNull(), sources[i][0]).otherwise(name)
    return out.select(*targets.columns, found.alias(value), name.alias("source"))


def only_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def in_request_order(df: DataFrame, key: str, wanted: Sequence[str]) -> DataFrame:
    """The rows of the wanted keys with their position in the request; unknown keys are skipped."""
    spark = df.sparkSession
    ask = spark.createDataFrame([(i, k) for i, k in enumerate(wanted)], f"position int, {key} string")
    return df.join(F.broadcast(ask), key)


def source_key(name: Column, needles: Sequence[tuple[str, str]], excluded: Sequence[str] = ()) -> Column:
    """The key of the first needle that a name holds, without regard to case; null for excluded names."""
    text = F.lower(name)
    out = F.lit(None).cast("string")
    for needle, key in reversed(needles):
        out = F.when(text.contains(needle), key).otherwise(out)
    for word in excluded:
        out = F.when(~text.contains(word), out)
    return out


def matched_countries(df: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """df with iso3 and how it was found, by plain names: alias where an alias (alias, iso3) names one country, ambiguous where it names several, else unmatched."""
    known = aliases.select(plain_name(F.col("alias")).alias("_plain"), "iso3").where("_plain <> '' and iso3 is not null")
    known = known.groupBy("_plain").agg(F.min("iso3").alias("_code"), (F.min("iso3") != F.max("iso3")).alias("_several"))
    both = df.withColumn("_plain", plain_name(F.col(name))).join(known, "_plain", "left")
    found = F.when(F.col("_several"), "ambiguous").when(F.col("_code").isNotNull(), "alias").otherwise("unmatched")
    return both.select(*df.columns, F.when(~F.col("_several"), F.col("_code")).alias("iso3"), found.alias("match"))
