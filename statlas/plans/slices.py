"""Two end-to-end slices: a scored comparison with a reference matrix, and an investigation of one concept over sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.functions import scalars as S
from statlas.operators import concepts, joins
from statlas.sources.registry import Registry

# Authority and specificity of the slice's evidence, its confidence by temporal fit.
AUTHORITY, SPECIFICITY = 70, 80
FIT_EXACT, FIT_PROXY = 100, 80


def social_score(hdi):
    """0 to 10 from a 0 to 1 index, half to even."""
    return F.bround(S.clamp(hdi) * 10, 0).cast("int")


def integrity_score(z):
    """0 to 10 from a z-score between -2.5 and 2.5."""
    return F.bround(S.clamp((z + 2.5) / 5) * 10, 0).cast("int")


def scores(entities: DataFrame, rows: DataFrame, target: int, proxy: int) -> DataFrame:
    """social and integrity of each entity (iso3) for a target year; a missing year falls back to the proxy year.

    rows: iso3, year, variable_name, value, with hdi and control_of_corruption.
    """
    out = None
    for name, variable, score in (("social", "hdi", social_score), ("integrity", "control_of_corruption", integrity_score)):
        own = rows.where(F.col("variable_name") == variable).withColumn("_o", F.col("value"))
        found = joins.preferred_year(entities.select("iso3"), own, ["iso3"], target, proxy, "value", "_o")
        is_proxy = F.col("year_used") != target
        sure = F.when(F.col("value").isNotNull(), S.confidence(F.lit(100), F.lit(AUTHORITY), F.lit(SPECIFICITY), F.when(is_proxy, FIT_PROXY).otherwise(FIT_EXACT))).otherwise(0)
        part = found.select("iso3", F.lit(name).alias("category"), score(F.col("value")).alias("score"), "year_used", F.coalesce(is_proxy, F.lit(False)).alias("is_proxy"), sure.alias("confidence"))
        out = part if out is None else out.unionByName(part)
    return out


def comparison(ours: DataFrame, client: DataFrame) -> DataFrame:
    """Scores next to a reference matrix (iso3, category, client_score), with status and review flag."""
    both = ours.join(client, ["iso3", "category"], "left")
    theirs = F.col("client_score")
    return both.select("*", (F.col("score") - theirs).alias("delta"), S.match_status(F.col("score"), theirs).alias("status"), S.needs_review(F.col("score"), theirs, F.col("confidence"), F.col("is_proxy")).alias("review"))


def timeseries(entities: DataFrame, rows: DataFrame, years: Sequence[int], target: int, proxy: int) -> DataFrame:
    """Scores for several years: only the target year may use the proxy year, others are exact."""
    out = None
    for y in years:
        part = scores(entities, rows, y, proxy if y == target else y).withColumn("year", F.lit(y))
        out = part if out is None else out.unionByName(part)
    return out


def investigation(registry: Registry, spark, paths: dict[str, str], mapping: DataFrame, concept: str, countries: Sequence[str], years: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(rows, rows by source) of a concept over the observations of several sources; no row at all is an error."""
    observations = registry.run_all(spark, paths)
    rows = concepts.direct(observations, mapping.where(F.col("concept") == concept))
    rows = rows.where(F.col("country_code").isin(list(countries)) & F.col("year").between(*years)).orderBy("country_code", "year", "source_id", "indicator_code")
    if not rows.limit(1).count():
        raise ValueError(f"no rows of {concept} for {list(countries)} in {years}")
    return rows, rows.groupBy("source_id").agg(F.count("*").alias("n_rows"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def review_queue(compared: DataFrame) -> DataFrame:
    """The rows of a comparison that a person should look at, the largest differences first."""
    return compared.where("review").orderBy(F.desc_nulls_last(F.abs("delta")), "iso3", "category")


def summary(compared: DataFrame) -> DataFrame:
    """By category: entities, scored ones, each status and rows to review."""
    status = [F.count_if(F.col("status") == x).alias(x) for x in ("match", "conflict", "high_delta", "missing")]
    return compared.groupBy("category").agg(F.count("*").alias("entities"), F.count("score").alias("scored"), *status, F.count_if("review").alias("review"))


def summary_markdown(compared: DataFrame, title: str) -> str:
    """summary() as a Markdown table; a row per category reaches the driver."""
    table = summary(compared).orderBy("category")
    lines = [f"# {title}", "", "| " + " | ".join(table.columns) + " |", "|" + " --- |" * len(table.columns)]
    lines += ["| " + " | ".join(str(x) for x in row) + " |" for row in table.collect()]
    return "\n".join(lines) + "\n"
