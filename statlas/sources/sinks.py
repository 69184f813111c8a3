"""Sinks: tables replaced by source and year, upserts, manifests, single CSV files with attribution."""

from __future__ import annotations

import csv
import json
import os
import tempfile
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlas.sources.readers import csv_strings


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str] = ("source_id", "year")) -> None:
    """Write df and replace exactly the partitions that it has rows of; running it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def upserted(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """base with the non-null fields of changes by key, and with its new keys."""
    both = base.alias("b").join(changes.alias("c"), list(keys), "full")
    cells = [F.coalesce(F.col(f"c.{x}"), F.col(f"b.{x}")).alias(x) if x in changes.columns else F.col(f"b.{x}") for x in base.columns if x not in keys]
    return both.select(*keys, *cells)


def without_tagged(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """df without the rows that a run of ours wrote."""
    return df.where(~F.coalesce(F.startswith(F.col(column), F.lit(prefix)), F.lit(False)))


def run_manifest(df: DataFrame, source: str, attribution: str = "") -> dict:
    """Counts, years and indicators of a run; one aggregate row reaches the driver."""
    row = df.agg(F.count("*").alias("n"), F.min("year").alias("first"), F.max("year").alias("last"), F.array_sort(F.collect_set("indicator_code")).alias("indicators")).first()
    return {"source": source, "rows": row["n"], "first_year": row["first"], "last_year": row["last"], "indicators": row["indicators"], "attribution": attribution}


def manifest(df: DataFrame, path: str, source: str, attribution: str = "") -> dict:
    """run_manifest() as JSON with sorted keys."""
    found = run_manifest(df, source, attribution)
    atomic_text(path, json.dumps(found, sort_keys=True, indent=1) + "\n")
    return found


def atomic_text(path: str, text: str) -> None:
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=target.parent, delete=False, newline="", encoding="utf-8") as file:
        file.write(text)
    os.replace(file.name, target)


def write_csv(df: DataFrame, path: str, columns: Sequence[str], comments: Sequence[str] = (), formats: Mapping[str, str] | None = None) -> int:
    """One CSV file: comment lines, header, rows as they come from the (sorted) frame, a partition at a time; null is empty."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with tempfile.NamedTemporaryFile("w", dir=target.parent, delete=False, newline="", encoding="utf-8") as file:
        for line in comments:
            file.write(f"# {line}\r\n")
        out = csv.writer(file, lineterminator="\r\n")
        out.writerow(columns)
        for row in df.select(*columns).toLocalIterator():
            out.writerow(["" if v is None else format(v, (formats or {}).get(c, "")) if c in (formats or {}) else v for c, v in zip(columns, row, strict=True)])
            n += 1
    os.replace(file.name, target)
    return n


def write_csv_parts(df: DataFrame, path: str, columns: Sequence[str], formats: Mapping[str, str] | None = None) -> None:
    """CSV with a header in as many files as df has partitions, written by tasks: for tables that no single file should hold."""
    cells = [F.when(F.col(c).isNotNull(), F.format_string(formats[c], c)).alias(c) if c in (formats or {}) else F.col(c).cast("string").alias(c) for c in columns]
    df.select(*cells).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def save_typed(spark: SparkSession, path: str, table: str, types: Mapping[str, str]) -> int:
    """CSV at path as a table with the types stated; cells that do not fit are null, columns that are not named are left out."""
    database = table.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    df = csv_strings(spark, path)
    flag = lambda c: F.when(F.lower(c).isin("true", "1", "yes"), True).when(F.lower(c).isin("false", "0", "no"), False)
    cells = [(flag(F.trim(c)) if kind == "boolean" else F.trim(c).try_cast(kind)).alias(c) for c, kind in types.items()]
    df.select(*cells).write.mode("overwrite").saveAsTable(table)
    return spark.table(table).count()


def score_rows(scores: DataFrame) -> DataFrame:
    """Scores as text cells: NA where there is no score, four decimals, flags joined by |; by country and category."""
    shown = F.when(F.col("score_1_10").isNull(), "NA").otherwise(F.col("score_1_10").cast("string"))
    exact = F.when(F.col("normalized_score").isNull(), "NA").otherwise(F.format_number("normalized_score", 4))
    return scores.withColumns({"score_1_10": shown, "normalized_score": exact}).orderBy("country_iso3", "category")


def write_scores(scores: DataFrame, path: str, attribution: Sequence[str] = ()) -> int:
    df = score_rows(scores)
    return write_csv(df, path, df.columns, attribution)


def attribution_lines(used: DataFrame, texts: Mapping[str, str]) -> list[str]:
    """Attribution of each used source (one column of names), sorted."""
    names = sorted(r[0] for r in used.distinct().collect() if r[0] is not None)
    return [f"{n}: {texts.get(n, 'no attribution text')}" for n in names]


def with_metadata(df: DataFrame, column: str, metadata: Mapping[str, str]) -> DataFrame:
    """df with metadata on a column, which parquet keeps in its schema."""
    return df.withColumn(column, F.col(column).alias(column, metadata=dict(metadata)))


def save_bundle(spark: SparkSession, required: Mapping[str, str], optional: Mapping[str, str], database: str) -> dict[str, int]:
    """CSV tables saved as typed tables of a database, with their row counts; a required one must be there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    counts = {}
    for name, path in {**required, **optional}.items():
        if name in optional and not Path(path).exists():
            continue
        if not Path(path).exists():
            raise FileNotFoundError(path)
        spark.read.option("header", True).option("inferSchema", True).csv(path).write.mode("overwrite").saveAsTable(f"{database}.{name}")
        counts[name] = spark.table(f"{database}.{name}").count()
    return counts
