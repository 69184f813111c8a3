"""Semantic query specs: the metric registry, the vocabulary, and the checks before anything is planned."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

AGGREGATIONS = ("none", "count", "sum", "mean", "median", "min", "max", "weighted_mean")
TRANSFORMS = ("identity", "rolling_mean", "year_over_year_change", "index_to_base_year", "per_capita", "log10", "min_max_normalize")
OPERATORS = ("eq", "in", "gte", "lte")
GRAINS = ("country_year", "ruler_year", "category_score")
FIRST_YEAR, LAST_YEAR = 1900, 2100


@dataclass(frozen=True)
class Metric:
    metric_id: str
    label: str
    grain: str
    value_column: str
    unit: str
    tables: tuple[str, ...]
    columns: tuple[str, ...]
    aggregations: tuple[str, ...] = ("none",)
    transforms: tuple[str, ...] = ("identity",)
    sources: tuple[str, ...] = ()
    reference_only: bool = False


def _score(name: str, label: str, column: str, unit: str, table: str, **more: Any) -> Metric:
    return Metric(f"score.{name}", label, "category_score", column, unit, (table,), ("country_iso3", "year", "category_key"), **more)


def _chronicle(name: str, label: str, unit: str, aggregations: tuple[str, ...], sources: tuple[str, ...]) -> Metric:
    return Metric(f"chronicle.{name}", label, "country_year", name, unit, ("country_year_chronicle",), ("country_iso3", "year"), ("none", *aggregations), ("identity",), sources)


_ECONOMY = ("maddison_project", "wdi", "vdem")

#: The metrics with what each allows.
METRICS: dict[str, Metric] = {
    m.metric_id: m
    for m in (
        _score("system_proposed_1_10", "System proposed score", "system_proposed_score", "score_1_10", "ruler_scores", aggregations=("none", "mean")),
        _score("confidence_0_100", "Confidence", "confidence_score", "score_0_100", "validation_results", aggregations=("none", "mean")),
        _score("delta_vs_client", "Delta vs client reference", "score_delta_vs_client", "score_points", "ruler_scores", reference_only=True),
        _chronicle("population", "Population", "persons", ("sum",), _ECONOMY),
        _chronicle("gdp_per_capita", "GDP per capita", "source_native", ("mean",), _ECONOMY),
        _chronicle("gdp", "GDP", "source_native", ("sum", "mean"), _ECONOMY),
        _chronicle("political_regime_bucket", "Political regime bucket", "category", ("count",), ("vdem",)),
        _chronicle("existence_status", "Existence status", "status", ("count",), ("vdem",)),
    )
}


class SpecError(ValueError):
    """A query that the vocabulary or a metric does not allow."""


@dataclass(frozen=True)
class Filter:
    field: str
    operator: str
    value: Any


@dataclass(frozen=True)
class Transform:
    kind: str = "identity"
    metric_ids: tuple[str, ...] = ()
    window: int | None = None
    base_year: int | None = None


@dataclass(frozen=True)
class Query:
    metric_ids: tuple[str, ...]
    grain: str = "country_year"
    time_range: tuple[int, int] | None = None
    filters: tuple[Filter, ...] = ()
    aggregation: str = "none"
    group_by: tuple[str, ...] = ()
    weight_metric_id: str | None = None
    transforms: tuple[Transform, ...] = field(default_factory=tuple)


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise SpecError(message)


def validated(query: Query, strict: bool = True) -> Query:
    """query, if it keeps to the vocabulary; strict: and to what its metrics allow, and to what is executed without extensions."""
    _need(bool(query.metric_ids), "a query needs a metric")
    _need(query.grain in GRAINS, f"unknown grain {query.grain}")
    _need(query.aggregation in AGGREGATIONS, f"unknown aggregation {query.aggregation}")
    for m in query.metric_ids:
        _need(m in METRICS, f"unknown metric {m}")
        _need(METRICS[m].grain == query.grain, f"metric {m} has grain {METRICS[m].grain}, not {query.grain}")
    if query.time_range is not None:
        low, high = query.time_range
        _need(FIRST_YEAR <= low <= LAST_YEAR and FIRST_YEAR <= high <= LAST_YEAR, "years are from 1900 to 2100")
        _need(low <= high, "the time range ends before it starts")
    for f in query.filters:
        _need(bool(f.field), "a filter needs a field")
        _need(f.operator in OPERATORS, f"unknown filter operator {f.operator}")
        _need(f.operator != "in" or isinstance(f.value, list | tuple | set), f"filter {f.field} with in needs a list")
    if query.aggregation == "weighted_mean":
        weight = METRICS.get(query.weight_metric_id or "")
        _need(query.weight_metric_id is not None, "weighted_mean needs weight_metric_id")
        _need(weight is not None, f"unknown weight metric {query.weight_metric_id}")
        _need(not weight.reference_only, f"weight metric {query.weight_metric_id} is for reference only")
    for t in query.transforms:
        _need(t.kind in TRANSFORMS, f"unknown transform {t.kind}")
        _need(t.kind != "per_capita", "per_capita needs an explicit pair of metrics")
        _need(all(m in METRICS for m in t.metric_ids), "a transform names an unknown metric")
        _need(set(t.metric_ids) <= set(query.metric_ids), "a transform names a metric that is not selected")
        _need(t.kind != "rolling_mean" or (t.window or 0) >= 1, "rolling_mean needs a window")
        _need(t.kind != "index_to_base_year" or t.base_year is not None, "index_to_base_year needs a base year")
    if strict:
        for m in query.metric_ids:
            _need(query.aggregation in METRICS[m].aggregations, f"{query.aggregation} is not allowed for {m}")
            for t in query.transforms:
                if not t.metric_ids or m in t.metric_ids:
                    _need(t.kind in METRICS[m].transforms, f"{t.kind} is not allowed for {m}")
        _need(query.grain == "country_year", "only country_year queries run in strict mode")
    return query


def from_payload(payload: Mapping[str, Any]) -> Query:
    """A query from its JSON form, long or compact (metric, a named aggregation with group_by, a map of filters, a pair of years)."""
    raw = dict(payload)
    metric_ids = tuple(raw.get("metric_ids") or ([raw["metric"]] if "metric" in raw else []))
    _need(bool(metric_ids), "a query needs metric or metric_ids")
    _need(metric_ids[0] in METRICS, f"unknown metric {metric_ids[0]}")
    aggregation = raw.get("aggregation", "none")
    if isinstance(aggregation, str):
        aggregation = {"kind": aggregation, "group_by": raw.get("group_by", []), "weight_metric_id": raw.get("weight_metric_id")}
    filters = raw.get("filters", [])
    if isinstance(filters, Mapping):
        filters = [{"field": k, "operator": "eq", "value": v} for k, v in filters.items()]
    years = raw.get("time_range")
    if isinstance(years, Mapping):
        years = (years["start_year"], years["end_year"])
    return Query(
        metric_ids=metric_ids,
        grain=raw.get("grain", METRICS[metric_ids[0]].grain),
        time_range=tuple(years) if years is not None else None,
        filters=tuple(Filter(**f) for f in filters),
        aggregation=aggregation.get("kind", "none"),
        group_by=tuple(aggregation.get("group_by", ())),
        weight_metric_id=aggregation.get("weight_metric_id"),
        transforms=tuple(Transform(**{**t, "metric_ids": tuple(t.get("metric_ids", ()))}) for t in raw.get("transforms", [])),
    )
