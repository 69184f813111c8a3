"""Pivots, unpivots, unions and ordered deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_pivot(df: DataFrame, keys: Sequence[str], names: str, values: Sequence[str], measures: Sequence[str], order: str) -> DataFrame:
    """Wide rows: the first non-null measure by order of each name, in one aggregate over a stated list of names.

    Keys without any value do not appear. With several measures columns are called measure_name, else name.
    """
    cells = []
    for m in measures:
        for v in values:
            own = (F.col(names) == v) & F.col(m).isNotNull()
            cells.append(F.min_by(F.when(own, F.col(m)), F.when(own, F.col(order))).alias(f"{m}_{v}" if len(measures) > 1 else v))
    some = reduce(lambda a, b: a | b, (F.col(m).isNotNull() for m in measures))
    return df.where(F.col(names).isin(list(values)) & some).groupBy(*keys).agg(*cells)


def long(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], skip_null: bool = True) -> DataFrame:
    """A row per key and column, with the variable's name."""
    out = df.unpivot(list(keys), list(columns), "_column", "value")
    pairs = [x for k, v in columns.items() for x in (F.lit(k), F.lit(v))]
    out = out.select(*keys, F.element_at(F.create_map(*pairs), F.col("_column")).alias("variable_name"), "value")
    return out.where(F.col("value").isNotNull()) if skip_null else out


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_wins(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key, the first in a stated order, by an aggregate that combines before the exchange."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, "_b.*").select(*df.columns)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate key {twice[0].asDict()}")
    return df


def event_grid(events: DataFrame, entity: str, period: str, kind: str, amount: str, kinds: Sequence[str]) -> DataFrame:
    """Counts and sums by entity and period over the full grid of both, in one conditional aggregate; cells without events are 0.

    For each kind: n_<kind> and sum_<kind>; null amounts add nothing.
    """
    cells = [F.count("*").alias("n_all")]
    for k in kinds:
        own = F.col(kind) == k
        cells += [F.count_if(own).alias(f"n_{k}"), F.coalesce(F.sum(F.when(own, F.col(amount))), F.lit(0.0)).alias(f"sum_{k}")]
    agg = events.groupBy(entity, period).agg(*cells)
    entities, periods = agg.select(entity).distinct(), agg.select(period).distinct()
    filled = {"n_all": 0} | {f"n_{k}": 0 for k in kinds} | {f"sum_{k}": 0.0 for k in kinds}
    return entities.crossJoin(F.broadcast(periods)).join(agg, [entity, period], "left").na.fill(filled)
