"""Importance resampling towards a target: documents whose words are spread as in the target texts are drawn more often.

Features are runs of consecutive words, counted in buckets by their crc32. Two Arrow passes:

1. each partition counts its features by bucket (np.bincount) and gives one vector; treeReduce adds the vectors, so the
   driver sees one vector for the documents and one for the target, whatever their size;
2. the gains, one whole number for each bucket, go out as a broadcast of that fixed length; a document's gains are
   gathered by bucket and summed with np.bincount weights.

Gumbel noise from a hash of the id turns the mean gain into a score, so that the highest scores are a draw without
replacement. Scores are whole numbers in a narrow range, so their histogram is small whatever the input: it gives the
score at the cut, and only rows from there on are put in order, by ranges and with one offset for each range.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table, whole_id
from .wordhash import LOWER, PUNCT, buffers, runs, word_spans

BUCKETS = 10_000
RUN_WORDS = 1
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
#: Words of more bytes than this are hashed one by one, the others side by side.
LONG_WORD = 256
#: Drawn rows in one range, and the most ranges; the offsets that go to the driver and back are as many as ranges.
ROWS_A_RANGE, MOST_RANGES = 4096, 10_000


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def crc_of_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """crc32 of each span of bytes; with before, of what has that crc32 and the span after it."""
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint32) if before is None else before.copy()
    for k in np.flatnonzero(sizes > LONG_WORD):
        out[k] = zlib.crc32(raw[starts[k] : ends[k]].tobytes(), int(out[k]))
    order = np.argsort(np.where(sizes > LONG_WORD, 0, sizes).astype(np.uint16), kind="stable")[::-1]
    at, size = starts[order], sizes[order]
    size = np.where(size > LONG_WORD, 0, size)
    state = ~out[order]
    live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")  # spans longer than k
    for k, n in enumerate(live):
        state[:n] = _CRC[(state[:n] ^ raw[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = ~state
    return out


def features(raw: np.ndarray, at: np.ndarray, words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of all features of the rows, and the number of words of each row."""
    raw = LOWER[raw]
    starts, ends, first = word_spans(raw, at, PUNCT)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words)), n_words)
    crc = crc_of_spans(raw, starts, ends)
    rows, found = [row], [crc]
    for k in range(1, words):
        n = len(starts) - k
        if n <= 0:
            break
        crc = _CRC[(~crc[:n] ^ np.uint32(0x20)) & np.uint32(255)] ^ (~crc[:n] >> np.uint32(8))  # a space
        crc = crc_of_spans(raw, starts[k:], ends[k:], ~crc)
        whole = row[:n] == row[k:]
        rows.append(row[:n][whole])
        found.append(crc[whole])
    return np.concatenate(rows), (np.concatenate(found) % np.uint32(buckets)).astype(np.int64), n_words


def _counted(batches: Iterable[pa.RecordBatch], words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, _, raw, at in runs(*buffers(batch.column(0))):
            total += np.bincount(features(raw, at, words, buckets)[1], minlength=buckets)
    yield pa.record_batch({"counts": pa.array([total.tobytes()], pa.binary())})


def _vector(row) -> np.ndarray:
    return np.frombuffer(row[0], np.int64)


def bucket_counts(texts: DataFrame, text_col: str = "text", *, words: int = RUN_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket. One vector leaves each partition; they are added in rounds on the executors."""
    spark = texts.sparkSession
    found = texts.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(partial(_counted, words=words, buckets=buckets), "counts binary")
    none = spark.sparkContext.parallelize([np.zeros(buckets, np.int64)], 1)  # for a table without partitions
    return found.rdd.map(_vector).union(none).treeReduce(np.add, depth=3)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket a thousand times the logarithm of its share in the target over its share in the corpus, both smoothed
    by one, rounded down."""
    n = len(corpus)
    own, theirs = float(corpus.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((float(t + 1) * own) / (float(s + 1) * theirs))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _weighed(batches: Iterable[pa.RecordBatch], gain: Callable[[], np.ndarray], words: int) -> Iterator[pa.RecordBatch]:
    table_ = gain()
    for batch in batches:
        n, n_words, sums = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for first, last, raw, at in runs(*buffers(batch.column(1))):
            row, bucket, count = features(raw, at, words, len(table_))
            n[first:last] = np.bincount(row, minlength=last - first)
            n_words[first:last] = count
            sums[first:last] = np.bincount(row, table_[bucket], last - first)  # whole numbers, exact in doubles
        weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
        yield pa.record_batch({"doc_id": batch.column(0), "n_features": pa.array(n), "n_words": pa.array(n_words), "weight": pa.array(weight)})


def weigh(docs: DataFrame, gain: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, n_features, n_words, weight): the mean gain of each row's features, rounded down; 0 without features."""
    held = docs.sparkSession.sparkContext.broadcast(gain)
    rows = docs.select(whole_id(docs, id_col).alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _weighed(b, lambda: held.value, words), "doc_id long, n_features long, n_words long, weight long")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", words: int = RUN_WORDS, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score, rank.

    rank numbers the drawn rows from 1 by score, highest first, ties to the smaller id; it is null for the others. Drawn
    are `percent` in a hundred of the rows with at least least_words words, rounded down.

    A null or empty text has no features and weight 0, and is never drawn unless least_words is 0. Words are runs of
    ASCII letters (in lower case) and digits and of any other characters beyond ASCII, of texts of any length. A null id
    has the noise of the id "null" and comes after all others among ties. Rows with one id have the same noise; equal
    rows are drawn each for itself, in any order among them. An empty target or table is allowed (no rows: an empty
    result). Other columns of either table are ignored, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resample")
    gain = gains(bucket_counts(docs, text_col, words=words, buckets=buckets), bucket_counts(target, target_col, words=words, buckets=buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    weighed = weigh(docs, gain, id_col=id_col, text_col=text_col, words=words)
    scored = scratch.write(weighed.withColumn("score", F.col("weight") + noise).withColumn("at", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    by_score = sorted(((r["score"], r["n"]) for r in able.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    drawn = sum(n for _, n in by_score) * percent // 100
    through = list(itertools.accumulate(n for _, n in by_score))
    k = next((i for i, n in enumerate(through) if n >= drawn), 0)
    columns = ["doc_id", "n_features", "weight", "score"]
    if not drawn:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    cut, n = by_score[k][0], through[k]
    chosen = able.where(F.col("score") >= cut)
    ranges = min(MOST_RANGES, -(-n // rows_a_range))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("at")]
    sorted_ = chosen.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # the partition, and the place in it in the lower 33 bits
    placed = scratch.write(sorted_.select(*columns, F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "placed")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts = spark.createDataFrame([(part, start) for (part, _), start in zip(sizes, itertools.accumulate((n for _, n in sizes), initial=0), strict=False)], "part long, start long")
    rank = F.col("start") + F.col("place") + 1
    ranked = placed.join(F.broadcast(starts), "part").select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    rest = scored.where((F.col("n_words") < least_words) | (F.col("score") < cut)).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionAll(rest)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH RECURSIVE tab(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) AS t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM tab WHERE k < 8),
crc AS (SELECT list(CAST(c AS BIGINT) ORDER BY i) AS tab FROM tab WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
dw AS (SELECT r, unnest(ws) AS w FROM d),
words AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dw UNION SELECT w FROM b)),
bucket AS (
  SELECT w, CAST(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, y: xor(c >> 8, tab[CAST((xor(c, y) & 255) + 1 AS BIGINT)]))) AS BIGINT) % 10000 AS k
  FROM words, crc),
s AS (SELECT k, count(*) AS n FROM dw JOIN bucket USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM b JOIN bucket USING (w) GROUP BY k),
gain AS (
  SELECT k, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE) / (CAST(s.n + 1 AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (k)),
m AS (SELECT r, count(*) AS n, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight FROM dw JOIN bucket USING (w) JOIN gain USING (k) GROUP BY r),
sc AS (
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN m USING (r)),
ranked AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM sc WHERE n_features >= 20) THEN CAST(place AS BIGINT) END AS rank FROM ranked
"""
