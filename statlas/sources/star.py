"""The star of ten tables as parquet tables of a database, with the checks that stand in for keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statlas.operators.reshape import assert_unique

# Tables with their columns, and the key that must be unique.
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "countries": ("id BIGINT, iso3 STRING, name STRING, region STRING, subregion STRING", ("iso3",)),
    "leaders": ("id BIGINT, full_name STRING, match_key STRING, gender STRING, birth_date DATE", ("id",)),
    "sources": ("id BIGINT, name STRING, version STRING, url STRING, license STRING, attribution STRING", ("name", "version")),
    "score_categories": ("id BIGINT, category_key STRING, label STRING", ("category_key",)),
    "country_years": ("id BIGINT, country_id BIGINT, year INT, population BIGINT, gdp DOUBLE", ("country_id", "year")),
    "leader_aliases": ("id BIGINT, leader_id BIGINT, alias STRING, source_id BIGINT", ("id",)),
    "ruler_spells": ("id BIGINT, country_id BIGINT, leader_id BIGINT, start_date DATE, end_date DATE, title STRING, source_id BIGINT, notes STRING", ("id",)),
    "ruler_years": ("id BIGINT, country_id BIGINT, leader_id BIGINT, year INT, days_in_office INT, is_primary BOOLEAN", ("id",)),
    "ruler_scores": ("id BIGINT, country_id BIGINT, year INT, category_id BIGINT, system_proposed_score INT, confidence_score INT, score_delta_vs_client INT, notes STRING", ("country_id", "year", "category_id")),
    "validation_results": ("id BIGINT, ruler_score_id BIGINT, client_score INT, status STRING, requires_review BOOLEAN, notes STRING", ("id",)),
    "source_observations": ("id BIGINT, source_id BIGINT, country_id BIGINT, leader_id BIGINT, year INT, variable_name STRING, raw_value STRING, normalized_value DOUBLE, unit STRING, source_row_reference STRING, confidence INT, notes STRING, created_at TIMESTAMP", ("id",)),
}


def create(spark: SparkSession, database: str) -> list[str]:
    """Create what is not there; running it again changes nothing. Observations are partitioned by source."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (columns, _) in TABLES.items():
        by = " PARTITIONED BY (source_id)" if name == "source_observations" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by}")
    return sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect())


def append(df: DataFrame, database: str, name: str) -> None:
    """Append rows whose key is unique in the table then; a repeated key is refused before anything is written."""
    spark, (_, key) = df.sparkSession, TABLES[name]
    columns = spark.table(f"{database}.{name}").columns
    rows = df.select(*columns)
    assert_unique(spark.table(f"{database}.{name}").unionByName(rows), key)
    rows.write.mode("append").insertInto(f"{database}.{name}")


def evidence(spark: SparkSession, database: str) -> DataFrame:
    """Observations with the names of their source and country."""
    o, s, c = (spark.table(f"{database}.{t}") for t in ("source_observations", "sources", "countries"))
    named = o.join(s.withColumnsRenamed({"id": "source_id", "name": "source_name"}).select("source_id", "source_name", "version"), "source_id")
    return named.join(c.withColumnsRenamed({"id": "country_id"}).select("country_id", "iso3"), "country_id")
