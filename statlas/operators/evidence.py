"""Evidence: membership filters, best observations, missing indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How bad a missing indicator is, by its role.
SEVERITY = {"required": "high", "preferred": "medium", "fallback": "low"}


#: What can be asked for: the columns that may hold it, and whether letters' case counts.
DIMENSIONS: dict[str, tuple[tuple[str, ...], bool]] = {
    "country": (("country_code", "country_name"), False),
    "indicator": (("indicator_code",), True),
    "source": (("source_id",), True),
    "family": (("family",), True),
    "leader": (("leader_id", "leader_name"), True),
    "year": (("year",), True),
}


def _member(columns: Sequence[str], values: Sequence, cased: bool) -> Column:
    if not values:
        return F.lit(False)
    cell = F.col if cased else lambda c: F.lower(F.trim(F.col(c)))
    wanted = list(values) if cased else [str(v).strip().lower() for v in values]
    return reduce(lambda a, b: a | b, (F.coalesce(cell(c).isin(wanted), F.lit(False)) for c in columns))


def matches(wanted: Mapping[str, Sequence]) -> Column:
    """Rows that match every dimension of wanted by one of its values; no values match nothing, a null never matches.

    Countries and leaders match by id or by name, countries whatever their letters' case.
    """
    unknown = set(wanted) - set(DIMENSIONS)
    if unknown:
        raise ValueError(f"unknown dimensions {sorted(unknown)}")
    return reduce(lambda a, b: a & b, (_member(columns, wanted[k], cased) for k, (columns, cased) in DIMENSIONS.items() if k in wanted), F.lit(True))


def matching(observations: DataFrame, wanted: Mapping[str, Sequence]) -> DataFrame:
    return observations.where(matches(wanted))


def one_manifest(manifests: DataFrame, source_id: str, run_id: str | None = None) -> DataFrame:
    """The manifest of a source's run; without a run the source must have one only."""
    found = manifests.where(F.col("source_id") == source_id)
    if run_id is not None:
        return found.where(F.col("run_id") == run_id)
    if found.limit(2).count() > 1:
        raise ValueError(f"{source_id} has several runs; name one")
    return found


def best_observations(observations: DataFrame, targets: DataFrame, keys: Sequence[str], allowed: Sequence[int]) -> DataFrame:
    """The best observation for each target (keys, target_year).

    Distances other than 0 must be among allowed. Order: exact years first, then the smaller distance, the later year, the
    lower source_id, the lower observation_id. The aggregate keeps one row per key before any exchange.
    """
    obs = observations.where(F.col("year").isNotNull())
    wanted = sorted({0, *map(abs, allowed)})
    # each target asks for a few years only: equality keys instead of a range
    years = [s * d for d in wanted for s in ((1, -1) if d else (1,))]
    asks = targets.select(*keys, "target_year", F.explode(F.array(*map(F.lit, years))).alias("_d")).withColumn("year", F.col("target_year") + F.col("_d"))
    hits = asks.join(obs, [*keys, "year"])
    columns = [c for c in obs.columns if c not in (*keys, "year")]
    order = F.struct(F.abs("_d").alias("_a"), (-F.col("year")).alias("_y"), F.col("source_id"), F.col("observation_id"))
    best = hits.groupBy(*keys, "target_year").agg(F.min_by(F.struct("year", *columns), order).alias("_b"))
    kind = F.when(F.col("year").isNull(), None).when(F.col("year") == F.col("target_year"), "direct").otherwise("proxy")
    return best.select(*keys, "target_year", "_b.*").withColumn("temporal_kind", kind)


def missing_indicators(expected: DataFrame, observed: DataFrame, source_known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected (keys, variable_name, source_id, role) rows without an observation, with reason and severity."""
    gone = expected.join(observed.select(*keys, "variable_name").distinct(), [*keys, "variable_name"], "left_anti")
    known = source_known.select("source_id", F.lit(True).alias("_known")).distinct()
    reason = F.when(F.col("_known"), "target_year_absent").otherwise("source_not_implemented")
    severity = F.lit("low")
    for role, level in SEVERITY.items():
        severity = F.when(F.col("role") == role, level).otherwise(severity)
    return gone.join(F.broadcast(known), "source_id", "left").select(*expected.columns, reason.alias("reason"), severity.alias("severity"))


def missingness_summary(expected: DataFrame, observed: DataFrame, missing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """By keys: expected, observed and missing counts, and counts by reason as a sorted text reason=n|..."""
    n_expected = expected.groupBy(*keys).agg(F.count_distinct("variable_name").alias("n_expected"))
    n_observed = observed.groupBy(*keys).agg(F.count_distinct("variable_name").alias("n_observed"))
    by_reason = missing.groupBy(*keys, "reason").agg(F.count("*").alias("n"))
    parts = by_reason.groupBy(*keys).agg(F.sum("n").alias("n_missing"), F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "reason", "n"))), "|").alias("by_reason"))
    out = n_expected.join(n_observed, list(keys), "left").join(parts, list(keys), "left")
    return out.na.fill({"n_observed": 0, "n_missing": 0, "by_reason": ""})


def minimum_viable(observed: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    return observed.groupBy(*keys).agg((F.count_distinct("source_id") >= k).alias("viable"))
