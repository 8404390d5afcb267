"""Whether two builds hold the same records, by trees of digests.

Records are dealt to blocks by a hash of their key, so a record that comes or goes touches one block only. A block's
digest is that of its records in order of their keys; a node's is that of its children; the root tells whether two builds
are equal, byte for byte. Trees of two builds are compared from the root down, and only nodes that differ are followed,
so the records that are looked at are those of the blocks that differ.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import kept

#: Records in a block, about; bits of a block's number that one level of the tree takes.
RECORDS_A_BLOCK, BITS_A_LEVEL = 1024, 6
#: Digests are joined this way before they are digested again.
_SEP = "\n"


def block_bits(records: Mapping[str, DataFrame]) -> int:
    """Bits of a block's number, so that blocks of the largest kind hold about RECORDS_A_BLOCK records. Two trees can be compared if they were built with the same."""
    most = max((df.count() for df in records.values()), default=0)
    return BITS_A_LEVEL * max(1, math.ceil(math.log2(max(2, most / RECORDS_A_BLOCK)) / BITS_A_LEVEL))


class Tree:
    """Leaves (kind, block, key, digest: one row for each record) and levels (kind, node, digest), the finest first. Null keys are a key of their own; records
    of equal keys are digested together, in order of their digests."""

    def __init__(self, records: Mapping[str, DataFrame], bits: int, keys: Mapping[str, tuple[str, ...]] | None = None) -> None:
        self.bits = bits
        leaves = reduce(DataFrame.unionAll, (self._leaves(kind, df, (keys or {}).get(kind, ("id",))) for kind, df in records.items()))
        self.leaves = kept(leaves, "leaves")
        joined = lambda items: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(items)), lambda x: x["digest"]), _SEP), 256).alias("digest")
        # a block holds about a thousand records, a node at most 64 children
        level = kept(self.leaves.groupBy("kind", F.col("block").alias("node")).agg(joined(F.struct("key", "digest"))), "blocks")
        self.levels = [level]
        for _ in range(bits // BITS_A_LEVEL):
            level = level.groupBy("kind", F.shiftright("node", BITS_A_LEVEL).alias("node")).agg(joined(F.struct("node", "digest")))
            self.levels.append(level)

    def _leaves(self, kind: str, rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
        digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"}), 256)
        one = rows.select(F.to_json(F.struct(*key), {"ignoreNullFields": "false"}).alias("key"), digest.alias("digest"))
        # records of one key become one leaf: their number and the sum of their digests' halves, which needs no list of them
        sums = [F.sum(F.conv(F.substring("digest", 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(5)]
        once = one.groupBy("key").agg(F.when(F.count("*") == 1, F.min("digest")).otherwise(F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.min("digest"), F.max("digest"), *sums), 256)).alias("digest"))
        block = F.shiftrightunsigned(F.xxhash64("key"), 64 - self.bits)
        return once.select(F.lit(kind).alias("kind"), block.alias("block"), "key", "digest")

    def roots(self) -> dict[str, str]:
        """The digest of each kind that has records."""
        return {r["kind"]: r["digest"] for r in self.levels[-1].collect()}


def differences(one: Tree, other: Tree) -> DataFrame:
    """(kind, block, key, change) of records that only the other build holds (added), only the first (removed), or that both hold with
    different contents (changed). Equal builds are told by their roots, without a look at any block."""
    if one.bits != other.bits:
        raise ValueError(f"trees of {one.bits} and {other.bits} bits can't be compared")
    found: DataFrame | None = None
    for a, b in zip(reversed(one.levels), reversed(other.levels), strict=True):
        if found is not None:
            parents = found.select("kind", F.col("node").alias("_up"))
            under = lambda x: x.join(parents, (x["kind"] == parents["kind"]) & (F.shiftright(x["node"], BITS_A_LEVEL) == parents["_up"]), "left_semi")
            a, b = under(a), under(b)
        met = a.withColumnRenamed("digest", "was").join(b, ["kind", "node"], "full").where("NOT (was <=> digest)").select("kind", "node")
        found = kept(met, "differing")
    assert found is not None
    blocks = found.withColumnRenamed("node", "block")
    was, now = (t.leaves.join(blocks, ["kind", "block"], "left_semi") for t in (one, other))
    both = was.withColumnRenamed("digest", "was").join(now, ["kind", "block", "key"], "full").where("NOT (was <=> digest)")
    return both.select("kind", "block", "key", F.when(F.col("was").isNull(), "added").when(F.col("digest").isNull(), "removed").otherwise("changed").alias("change"))
