"""What is written once and gone on from keeps no shuffle files on the way."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlas.llm._util import cut
from statlas.llm.components import connected_components


def shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_their_action(spark):
    before = shuffle_files(spark)
    counted = cut(spark.range(1000, numPartitions=3).groupBy((F.col("id") % 100).alias("a")).agg(F.max("id").alias("b")))
    assert counted.count() == 100
    edges = cut(spark.range(200, numPartitions=3).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    linked = cut(connected_components(edges))
    left = {f.split("_")[1] for f in shuffle_files(spark) - before}
    assert len(left) <= 2  # count() above has one of its own
    assert linked.where("component = 0").count() == 201
