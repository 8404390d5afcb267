"""Digest trees: equal builds have equal roots, changed records are named."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corvane.plans import rebuild


def build(spark, change=None):
    docs = spark.range(5000).select(F.concat(F.lit("fa:document:"), "id").alias("id"), (F.col("id") % 7).alias("n"), F.when(F.col("id") % 3 == 0, F.lit("x")).alias("t"))
    lines = spark.range(300).select(F.concat(F.lit("o"), F.col("id") % 100).alias("outputId"), F.col("id").alias("v"))
    return {"documents": change(docs) if change else docs, "lineage": lines}


KEYS = {"lineage": ("outputId",)}


def tree(spark, change=None, parts=3, bits=12):
    records = {k: df.repartition(parts) for k, df in build(spark, change).items()}
    return rebuild.Tree(records, bits, KEYS)


def test_trees(spark):
    one = tree(spark)
    same = tree(spark, parts=7)
    assert one.roots() == same.roots() and set(one.roots()) == {"documents", "lineage"}
    assert rebuild.differences(one, same).collect() == []
    assert len(one.levels) == 3 and one.levels[0].where("kind = 'documents'").count() > 1000
    third = F.col("id") == "fa:document:3"
    change = lambda d: d.where("id <> 'fa:document:10'").withColumn("n", F.when(third, 99).otherwise(F.col("n"))).unionByName(spark.createDataFrame([("fa:document:new", 1, None), (None, 2, "y")], "id string, n long, t string"))
    other = tree(spark, change)
    found = {(r["kind"], json.loads(r["key"])["id"], r["change"]) for r in rebuild.differences(one, other).collect()}
    assert found == {("documents", "fa:document:3", "changed"), ("documents", "fa:document:10", "removed"), ("documents", "fa:document:new", "added"), ("documents", None, "added")}
    assert one.roots()["lineage"] == other.roots()["lineage"] and one.roots()["documents"] != other.roots()["documents"]
    back = {(json.loads(r["key"])["id"], r["change"]) for r in rebuild.differences(other, one).collect()}
    assert ("fa:document:10", "added") in back and ("fa:document:new", "removed") in back


def test_repeated_keys_and_bits(spark):
    twice = lambda d: d.unionAll(d.where("id = 'fa:document:5'"))
    found = rebuild.differences(tree(spark), tree(spark, twice)).collect()
    assert [(json.loads(r["key"])["id"], r["change"]) for r in found] == [("fa:document:5", "changed")]
    with pytest.raises(ValueError, match="bits"):
        rebuild.differences(tree(spark), tree(spark, bits=6))
    assert rebuild.block_bits(build(spark)) == 6 and rebuild.block_bits({"a": spark.range(100_000_000)}) == 18
    empty = rebuild.Tree({"documents": build(spark)["documents"].limit(0)}, 6)
    assert empty.roots() == {}
