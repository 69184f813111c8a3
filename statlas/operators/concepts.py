"""Semantic concepts over observations: direct readings and derived ratios, with reasons for what is dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.functions.scalars import finite, is_finite

SCOPE = ("source_id", "country_code", "country_name", "leader_id", "leader_name", "year")


def direct(observations: DataFrame, mapping: DataFrame) -> DataFrame:
    """A concept row per observation whose (source_id, indicator_code) the mapping (concept, source_id, indicator_code) names.

    A value that is no finite number gives a null of type missing with a warning.
    """
    rows = observations.join(F.broadcast(mapping), ["source_id", "indicator_code"])
    good = is_finite(F.col("value"))
    return rows.withColumns(
        {
            "value": finite(F.col("value")),
            "value_type": F.when(good, "numeric").otherwise("missing"),
            "warning": F.when(~good, "non_numeric_value"),
        }
    )


def ratio(observations: DataFrame, numerator: str, denominator: str, scope: Sequence[str] = SCOPE) -> DataFrame:
    """One row per scope that has a side: value, or the first reason in order why there is none.

    Scopes with null parts are scopes of their own: the aggregate takes nulls as equal. Reasons: missing_numerator, missing_denominator,
    ambiguous, non_numeric_numerator, non_numeric_denominator, zero_denominator. Both input ids are carried.
    """
    top, bottom = F.col("indicator_code") == numerator, F.col("indicator_code") == denominator
    rows = observations.where(top | bottom)
    sides = rows.groupBy(*scope).agg(
        F.count_if(top).alias("_nt"),
        F.count_if(bottom).alias("_nb"),
        F.min(F.when(top, F.struct("observation_id", "value"))).alias("_t"),
        F.min(F.when(bottom, F.struct("observation_id", "value"))).alias("_b"),
    )
    t, b = F.col("_t.value"), F.col("_b.value")
    reason = (
        F.when(F.col("_nt") == 0, "missing_numerator")
        .when(F.col("_nb") == 0, "missing_denominator")
        .when((F.col("_nt") > 1) | (F.col("_nb") > 1), "ambiguous")
        .when(~is_finite(t), "non_numeric_numerator")
        .when(~is_finite(b), "non_numeric_denominator")
        .when(b == 0, "zero_denominator")
    )
    return sides.select(*scope, F.when(reason.isNull(), t / b).alias("value"), reason.alias("reason"), F.col("_t.observation_id").alias("numerator_id"), F.col("_b.observation_id").alias("denominator_id"))


def rows_and_warnings(derived: DataFrame) -> tuple[DataFrame, DataFrame]:
    return derived.where(F.col("reason").isNull()).drop("reason"), derived.where(F.col("reason").isNotNull()).drop("value")


class Catalog:
    """Concepts by key with the sources that each supports."""

    def __init__(self, mapping: dict[str, dict[str, tuple[str, ...]]]) -> None:
        self.mapping = mapping

    def list(self) -> list[str]:
        return sorted(self.mapping)

    def resolve(self, concept: str, source: str | None = None) -> dict[str, tuple[str, ...]]:
        if concept not in self.mapping:
            raise KeyError(f"unknown concept {concept}")
        found = self.mapping[concept]
        if source is not None and source not in found:
            raise LookupError(f"{concept} does not support {source}")
        return found if source is None else {source: found[source]}
