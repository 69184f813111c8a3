"""Category scores: weighted groups of indicators, confidence, flags and review.

Plans and rubrics are tables, so one plan scores every category and country at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.functions.scalars import clamp, flags, is_finite, one_to_ten


def usable(observations: DataFrame, plan: DataFrame, excluded: Sequence[str] = ("client_matrix",)) -> DataFrame:
    """Observations with a normalized value, of variables in the plan, whose source is not excluded; with the plan's columns."""
    named = ~F.col("source_id").isin(list(excluded)) & ~F.lower("source_id").contains("client")
    rows = observations.where(is_finite(F.col("normalized_value")) & named)
    return rows.join(F.broadcast(plan), ["category", "variable_name"])


def owned(rows: DataFrame) -> DataFrame:
    """Only rows whose source owns the variable."""
    return rows.where(F.col("source_id") == F.col("owning_source"))


def group_components(rows: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of each rubric group with its weight; a group without values contributes nothing and others are not weighted up."""
    means = rows.groupBy(*keys, "category", "rubric_group").agg(F.avg("normalized_value").alias("mean_value"), F.count("*").alias("n_valid"))
    return means.join(F.broadcast(weights), ["category", "rubric_group"]).withColumn("contribution", F.col("weight") * F.col("mean_value"))


def components(rows: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row per value: its weight is the group's over the number of values, its contribution value times weight."""
    counts = rows.groupBy(*keys, "category", "rubric_group").agg(F.count("*").alias("n_valid"))
    both = rows.join(counts, [*keys, "category", "rubric_group"]).join(F.broadcast(weights), ["category", "rubric_group"])
    share = F.col("weight") / F.col("n_valid")
    return both.withColumns({"component_weight": share, "contribution": share * F.col("normalized_value")})


def scored(observations: DataFrame, plan: DataFrame, weights: DataFrame, categories: DataFrame, entities: DataFrame, keys: Sequence[str] = ("country_iso3",)) -> DataFrame:
    """Score, missingness and flags for each entity and category.

    plan: category, variable_name, role, owning_source, rubric_group. weights: category, rubric_group, weight. categories:
    category, min_sources, fixed_flags (insufficient rows get a fixed pair of flags), owner_only. Entities without
    enough sources have no score and are kept.
    """
    rows = usable(observations, plan).join(F.broadcast(categories), "category")
    rows = rows.where(~F.col("owner_only") | (F.col("source_id") == F.col("owning_source")))
    by = [*keys, "category"]
    # one pass: groups of a rubric, then categories; the sets hold names of the plan and of sources, so they are small
    parts = rows.groupBy(*by, "rubric_group").agg(
        F.avg("normalized_value").alias("_mean"),
        F.collect_set("source_id").alias("_sources"),
        F.collect_set("variable_name").alias("_variables"),
        F.collect_set(F.when(F.col("role") == "required", F.col("variable_name"))).alias("_required"),
        F.max((F.col("temporal_kind") != "direct").cast("int")).alias("any_proxy"),
    )
    size = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c)))).cast("long")
    seen = parts.join(F.broadcast(weights), ["category", "rubric_group"], "left").groupBy(*by).agg(
        size("_sources").alias("n_sources"),
        size("_variables").alias("n_observed"),
        size("_required").alias("n_required"),
        F.max("any_proxy").alias("any_proxy"),
        F.sum(F.col("weight") * F.col("_mean")).alias("normalized_score"),
    )
    sizes = plan.groupBy("category").agg(F.count_distinct("variable_name").alias("n_expected"), F.count_distinct(F.when(F.col("role") == "required", F.col("variable_name"))).alias("n_need"))
    out = entities.select(*keys).distinct().crossJoin(F.broadcast(categories.join(sizes, "category")))
    out = out.join(seen, by, "left").na.fill(0, ["n_sources", "n_observed", "n_required", "any_proxy"])
    enough = F.col("n_sources") >= F.col("min_sources")
    value = F.when(enough, clamp(F.col("normalized_score")))
    lacks = F.col("n_required") < F.col("n_need")
    sparse = F.col("n_observed") / F.col("n_expected") < 0.5
    low = F.col("any_proxy") == 1
    derived = [(lacks, "missing_primary_source"), (sparse, "sparse_data"), (low, "low_confidence")]
    names = F.when(enough, flags(*derived)).when(F.col("fixed_flags"), F.lit("insufficient_data|sparse_data")).otherwise(flags((F.lit(True), "insufficient_data"), *derived))
    return out.select(
        *by,
        value.alias("normalized_score"),
        one_to_ten(value).alias("score_1_10"),
        F.when(enough, "scored").otherwise("insufficient_data").alias("status"),
        "n_expected",
        "n_observed",
        "n_sources",
        names.alias("flags"),
        (names != "").alias("needs_review"),
        F.concat_ws(" ", F.concat(F.lit("Category "), F.col("category"), F.lit(":")), F.concat(F.col("n_observed"), F.lit(" of "), F.col("n_expected"), F.lit(" indicators")), F.concat(F.lit("from "), F.col("n_sources"), F.lit(" sources."))).alias("rationale"),
    )


def coverage(df: DataFrame, keys: Sequence[str], status: str, value: str) -> DataFrame:
    """Existing rows with a value over existing rows, and counts of the other statuses."""
    exists = F.col(status) == "exists"
    n, have = F.count_if(exists), F.count_if(exists & F.col(value).isNotNull())
    return df.groupBy(*keys).agg(n.alias("n_existing"), have.alias("n_with_value"), F.count_if(~exists).alias("n_excluded"), F.when(n > 0, have / n).alias("coverage"))
