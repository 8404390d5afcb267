"""Shared helpers: table access, durable intermediate tables, word patterns, learning folds."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType, StructType

from ..session import shared_dir

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_id(df: DataFrame, col: str) -> Column:
    """The id as a long. Ids of other types than whole numbers are refused before anything runs."""
    kind = df.schema[col].dataType
    if not isinstance(kind, (IntegralType, NullType)):
        raise TypeError(f"column {col} must hold whole numbers, not {kind.simpleString()}: number the rows first")
    return F.col(f"`{col}`").cast("long")


def fresh(taken: Sequence[str], *names: str) -> list[str]:
    """Names for internal columns that no column of the input has, whatever the case of its letters."""
    known = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in known:
            name += "_"
        known.add(name.lower())
        out.append(name)
    return out


class Scratch:
    """Intermediate tables of one operator call, written as Parquet in the shared folder, so that a lost executor
    costs a reread and never a recomputation of the whole lineage. drop() frees a table that is no longer needed;
    tables that the returned DataFrame still reads stay until the application's folder is removed."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").mode("overwrite").parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


#: A key with more rows than this, and more than its part of a table, is met through a broadcast and not a shuffle.
HOT_ROWS, HOT_KEYS = 1000, 2000


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str], n: str, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """rows joined to keyed, a written table with one row for each key and in column n the number of rows that have it.

    Keys of more than hot_rows rows that hold more than one in hot_keys of all counted rows are hot. There are fewer than
    hot_keys of them, so they can always be broadcast, and their rows stay where they are; the other keys are shuffled,
    and none of them is large. The column n is left out.
    """
    total = keyed.agg(F.sum(n).alias("t")).first()["t"] or 0
    least = max(hot_rows, total // hot_keys)
    hot, plain = keyed.where(F.col(n) > least), keyed.where(F.col(n) <= least).drop(n).hint("merge")
    if not hot.head(1):
        return rows.join(plain, on)
    few = F.broadcast(hot.drop(n))
    return rows.join(few, on).unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(plain, on))


def n_words(text: Column | str) -> Column:
    """Words of the text as a long; null counts as no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the split between rows to learn from and rows held out."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n
