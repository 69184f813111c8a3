"""Session helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and make sure that there is a checkpoint folder."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    shared_dir(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; only where it is unset, and on one machine, a folder of our own."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or f"file://{tempfile.mkdtemp(prefix='statlas-checkpoint-')}")
    return named or sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def released(spark: SparkSession) -> AbstractContextManager[None]:
    """Actions inside remove their shuffle files when they end; else those stay until the driver collects its garbage."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Actions inside send texts to Python in batches of 4 MB; rows of numbers stay under that anyhow."""
    return _set(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def cut(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and go on from there."""
    shared_dir(df.sparkSession)
    with released(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a new frame, as the setting is read when a frame is made


def some(df: DataFrame) -> bool:
    """Whether df has a row."""
    with released(df.sparkSession):
        return bool(df.limit(1).count())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns: those given, with underscores before them until none is a column of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
