"""Keyed merges and set differences over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def append_segments(*segments: DataFrame) -> DataFrame:
    """Segments one after the other; columns that one lacks are null."""
    out = segments[0]
    for s in segments[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def last_wins(rows: DataFrame, key: list[str], *order: str) -> DataFrame:
    """For each key the row that comes last in the order."""
    last = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def first_wins(rows: DataFrame, key: list[str], value: str, priority: str) -> DataFrame:
    """For each key the value of least priority."""
    return rows.groupBy(*key).agg(F.min_by(value, priority).alias(value))


def difference(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Distinct keys of left without a match in right."""
    return left.select(*on).distinct().join(right.select(*on).distinct(), on, "left_anti")
