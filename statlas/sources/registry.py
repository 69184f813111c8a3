"""Sources by name: check, read, transform into observations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The long observation table; an ordinal keeps the order of emission.
OBSERVATION = (
    "source_id string, observation_id string, family string, indicator_code string, value double, value_text string, value_type string, year int, "
    "country_code string, country_name string, leader_id string, leader_name string, unit string, scale string, source_version string, "
    "raw_locator map<string,string>, transform_locator map<string,string>, quality_flags array<string>, warnings array<string>, extension map<string,string>"
)


@dataclass(frozen=True)
class Source:
    """A named source. ready says why it cannot be read, or nothing; read gives raw rows; transform gives observations."""

    slug: str
    read: Callable[[SparkSession, str], DataFrame]
    transform: Callable[[DataFrame], DataFrame]
    ready: Callable[[SparkSession, str], str | None] = lambda spark, path: None
    family: str = ""
    attribution: str = ""


class NotReady(RuntimeError):
    """A source whose input is not there."""


@dataclass
class Registry:
    sources: dict[str, Source] = field(default_factory=dict)

    def add(self, source: Source) -> Source:
        if source.slug in self.sources:
            raise ValueError(f"source {source.slug} is registered already")
        self.sources[source.slug] = source
        return source

    def get(self, slug: str) -> Source:
        if slug not in self.sources:
            raise KeyError(f"unknown source {slug}")
        return self.sources[slug]

    def list(self) -> list[str]:
        return sorted(self.sources)

    def run(self, spark: SparkSession, slug: str, path: str) -> DataFrame:
        source = self.get(slug)
        if reason := source.ready(spark, path):
            raise NotReady(f"{slug}: {reason}")
        return observations(source.transform(source.read(spark, path)), source)

    def run_all(self, spark: SparkSession, paths: dict[str, str]) -> DataFrame:
        frames = [self.run(spark, slug, path) for slug, path in sorted(paths.items())]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out


def observations(df: DataFrame, source: Source) -> DataFrame:
    """df in the columns of OBSERVATION; missing ones are null, the id is built from what identifies a row."""
    spark = df.sparkSession
    schema = spark.createDataFrame([], OBSERVATION).schema
    own = df.withColumn("source_id", F.lit(source.slug))
    if "family" not in own.columns:
        own = own.withColumn("family", F.lit(source.family))
    if "value_type" not in own.columns:
        own = own.withColumn("value_type", F.when(F.col("value").isNull(), "missing").otherwise("numeric"))
    if "observation_id" not in own.columns:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("country_code", "year", "indicator_code") if c in own.columns]
        own = own.withColumn("observation_id", F.concat_ws(":", F.lit(source.slug), *parts))
    cells = [(F.col(f.name) if f.name in own.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return own.select(*cells)


def long_transform(country: str, year: str, variables: Sequence[str], keep_missing: bool = False) -> Callable[[DataFrame], DataFrame]:
    """A transform from wide country-year rows to observations, a row per variable."""

    def transform(df: DataFrame) -> DataFrame:
        out = df.unpivot([country, year], list(variables), "indicator_code", "value").withColumnsRenamed({country: "country_code", year: "year"})
        return out if keep_missing else out.where("value is not null")

    return transform
