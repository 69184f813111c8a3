"""Distributed connected components (alternating large-star and small-star steps).

Nodes are longs. Each step is an aggregate and an equality join, so a hub's edges may be split
among tasks; each round is cut by a checkpoint in the shared folder. Edges are first contracted
inside the tasks that produce them. Nothing is gathered on the driver but one row per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.llm._util import cut, prepare, released


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same components as the edges a-b: each node but the smallest linked with the smallest of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        high = np.maximum(label[x], label[y])
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.asarray(c) for c in batch.columns)
        x, y = local_stars(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])


def _state(edges: DataFrame) -> tuple[int, int]:
    """The number of edges and a hash of their set; exclusive or cannot overflow."""
    with released(edges.sparkSession):
        row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return row["n"], row["h"] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    larger = both.where("b > a").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    edges: two columns of longs. Null ends and loops are ignored; repeated edges count once; no edges give no rows.
    """
    prepare(edges.sparkSession)
    a, b = edges.columns[:2]
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    edges = cut(edges.mapInArrow(_contract, "a long, b long").distinct())
    before = _state(edges)
    while before[0]:
        edges = cut(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b")).distinct()
