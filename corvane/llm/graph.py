"""Connected components over an edge table, on the executors.

Edges are first contracted inside each partition by union-find, which leaves at most one edge for each node; then the
large-star and small-star steps of Kiveris et al. run until the edges don't change. Every round is written to the shared
folder, so that a lost executor costs a reread. Nothing about single nodes reaches the driver, only a checksum of a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and for each the smallest node of its component. Labels spread along edges and are followed
    to their own labels (pointer jumping) until they stand still."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def contract(edges: DataFrame) -> DataFrame:
    """Replaces the edges (a, b) of each partition by one edge from each node to the smallest it reaches there."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.zeros(0, np.int64)
        for batch in it:
            a, b = union_find(np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()]))
        keep = a != b
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return edges.mapInArrow(batches, "a long, b long")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) for every node of the edges (a, b), both long and not null; label: the smallest node of its component."""
    now = contract(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null").repartition("a"))
    now = scratch.write(now.where("a > b"), f"{name}-0")
    before, rounds = None, 0
    while True:
        check = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if before == check:
            break
        before = check
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").union(low.select("a", F.col("m").alias("b"))).distinct()
        rounds += 1
        now = scratch.write(small, f"{name}-{rounds}")
        scratch.drop(f"{name}-{rounds - 1}")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
