"""Mixing sources to target weights, with DataFrame functions only.

Every row gets a hash-random key. Rows are range-partitioned by that key inside each source, word counts are summed
per (source, range), the sums are turned into offsets by a two-level prefix sum, and a running sum inside each range
gives every row's place in its source. A source's budget then cuts that order at an exact word; a budget above the
source's size goes round the same order again.

Ranges are sized from the row count, so that no task gets more than a few thousand rows however large a source is; no
step brings a source's rows together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh, n_words, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
ROWS_A_RANGE = 4096


def _key(doc_id: Column, seed: int) -> Column:
    """16 hexadecimal digits, random over ids, the same in every run."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 16)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """sizes: one row per source (source, source_size). Adds target: the source's share of `share` times all words by its
    weight, held at `most` times its size, with what is above that shared again by weight.

    The fixed point is a water level L with target = min(most * size, weight * L). Sources fill up in the order of
    most * size / weight; the level is read at the first source that doesn't fill. Runs over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * most).withColumn("budget", F.sum("source_size").over(everything).cast("double") * share)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = ranked.withColumn("num", F.col("budget") - F.sum("cap").over(fill) + F.col("cap")).withColumn("den", F.sum("weight").over(everything) - F.sum("weight").over(fill) + F.col("weight"))
    level = level.withColumn("full", F.col("cap") * F.col("den") <= F.col("weight") * F.col("num"))
    open_ = ~F.col("full")
    level = level.withColumn("l_num", F.max(F.when(open_, F.col("num"))).over(everything)).withColumn("l_den", F.max(F.when(open_, F.col("den"))).over(everything))
    return level.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("l_num") / F.col("l_den")).alias("target"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS, seed: int = 0, rows_a_range: int = ROWS_A_RANGE, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken.

    taken: words that the mix takes from the row, with repeats: whole passes over the source, and in the last pass the
    words up to the cut (the row that holds the cut gives its first words only). A null text has size 0 and gives nothing.
    A null source is a source of its own, last in order. Rows with equal ids have equal keys; among them the smaller
    goes first, and rows that are equal in all columns can change places without changing the result. A null id has a
    key like any other. An empty table gives an empty result. Other columns of the input are ignored; carry names
    expressions over the input to keep beside each row, and src, the source as a key that is never null.
    """
    carry = carry or {}
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"), *[c.alias(n) for n, c in carry.items()])
    sized = scratch.write(sized.withColumn("key", _key(F.col("doc_id"), seed)).withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), "sized")
    bits = max(0, math.ceil(math.log2(max(1, sized.count() / rows_a_range))))
    ranged = sized.withColumn("range", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), 32 - bits))
    sums = ranged.groupBy("src", "range").agg(F.sum("size").alias("words")).withColumn("block", F.shiftright("range", bits // 2))
    inner = Window.partitionBy("src", "block").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.groupBy("src", "block").agg(F.sum("words").alias("words"))
    outer = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("src", "block", F.coalesce(F.sum("words").over(outer), F.lit(0)).alias("block_start"))
    offsets = sums.withColumn("in_block", F.coalesce(F.sum("words").over(inner), F.lit(0))).join(starts, ["src", "block"]).select("src", "range", (F.col("block_start") + F.col("in_block")).alias("start"))
    totals = sized.groupBy("src").agg(F.first("source", ignorenulls=True).alias("source"), F.sum("size").alias("source_size"))
    targets = source_targets(totals.select("source", "source_size"), weights, share, most).withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    running = Window.partitionBy("src", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("through", F.sum("size").over(running)).join(offsets.join(targets, "src"), ["src", "range"])
    budget = F.floor("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - rounds * F.col("source_size") - (F.col("start") + F.col("through") - F.col("size"))
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *((*carry, "src") if carry else ()))


#: Between the end of a word and the white space after it.
WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself, with all columns of docs: each row as often as the mix takes it whole, and once more cut after the
    last word that it still takes. Rows that the mix doesn't reach, and those without words, don't appear.

    Rows with equal id, source and text share what the mix takes of them evenly, whole words only.
    """
    whole, taken_, own, src, content_, copy = fresh(docs.columns, "size", "taken", "id", "src", "content", "copy")
    content = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    mix = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, carry={"content": content}, **how)
    taken = mix.where("taken > 0").groupBy(F.col("doc_id").alias(own), F.col("src").alias(src), F.col("content").alias(content_)).agg(F.max("size").alias(whole), F.floor(F.sum("taken") / F.count("*")).cast("long").alias(taken_))
    source = F.col(f"`{source_col}`").cast("string")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(own)) & (content == F.col(content_)) & (F.coalesce(F.concat(F.lit("s"), source), F.lit("n")) == F.col(src))
    rows = docs.join(taken, same).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col(taken_) / F.col(whole)))))
    rest = (F.col(taken_) - (F.col(copy) - 1) * F.col(whole)).cast("int")
    body = F.col(f"`{text_col}`")
    cut = F.when(F.col(copy) * F.col(whole) <= F.col(taken_), body).otherwise(F.array_join(F.slice(F.split(body, WORD_END), F.lit(1), rest), ""))
    return rows.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5('0:' || CAST(doc_id AS VARCHAR)), 1, 16) AS key
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         CAST(source_size AS DOUBLE) * 2 AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget
  FROM totals),
level AS (
  SELECT *, budget - sum(cap) OVER f + cap AS num, sum(weight) OVER () - sum(weight) OVER f + weight AS den
  FROM ranked WINDOW f AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
filled AS (SELECT *, cap * den <= weight * num AS is_full FROM level),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE weight * (max(num) FILTER (NOT is_full) OVER ()) / (max(den) FILTER (NOT is_full) OVER ()) END AS target
  FROM filled),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS rounds FROM placed)
SELECT doc_id, size, source_size, target,
       CAST(rounds * size + greatest(0, least(size, budget - rounds * source_size - before)) AS BIGINT) AS taken
FROM cut
"""
