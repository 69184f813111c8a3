"""Session settings for this engine; everything else is left to the cluster."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def session(app: str = "statlas", **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and skew handling on; conf overrides, with _ for dots."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
    } | {k.replace("_", "."): v for k, v in conf.items()}
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()
