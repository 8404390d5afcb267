"""Exact removal of long repeated byte strings by a column-wise, multi-string Burrows-Wheeler construction.

Every window of `width` bytes is dealt by its minimizer (see superkmers), so equal windows meet, at equal places
relative to the minimizer. Strings of windows whose minimizer occurs once can't repeat and stay where they are; equal
strings are counted as one class before anything is moved; the different strings of a minimizer form collections that
are built into a Burrows-Wheeler transform with common prefixes:

Strings stand aligned at their minimizer. Each round takes the next column to the left and inserts one symbol of each
string: the suffixes that begin in the column are the previous ones with a symbol in front, so a stable sort by that
symbol orders them (the last-to-first mapping), and two neighbours with equal symbols share one symbol more than the least
common prefix between their places in the previous order. Only suffixes of one column can share a window, so the transform
is kept column by column and each round costs the number of strings, not the text so far. Symbols, order and common
prefixes go through sequential files: each round reads the last round's and writes its own. The files are anonymous and go
with their task. A window repeats where a neighbour's common prefix reaches the width, or where its class has two members.

A minimizer with more different strings than a task should hold is no collection: its strings are cut into windows,
and those are counted by partial aggregation, which spreads them over all tasks, however hot the minimizer is. Occurrences
meet the verdicts of their class by common.join_counted, so a passage with millions of copies is not one task either.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, join_counted, table, whole_id
from .superkmers import PIECE_WINDOWS, super_runs
from .wordhash import buffers, mix, runs, span_hashes

WIDTH, GRAM = 200, 40
COLLECTION_BYTES = 24 << 20
#: More different strings of one minimizer than this are counted window by window.
MOST_STRINGS = 20_000
#: Slots of the bitmaps that spare most rows the way to a join: the least, the most, and for each key. 2^28 slots are 32 MB.
LEAST_SLOTS, MOST_SLOTS, SLOTS_A_KEY = 1 << 20, 1 << 28, 16


class ColumnFiles:
    """The state between rounds: order and common prefixes are rewritten each round, the transform's columns appended.
    Files stay open and are overwritten in place, front to back; truncating and closing them would wait for the disk."""

    def __init__(self) -> None:
        self.order, self.lcp, self.columns = (os.fdopen(os.memfd_create(n), "w+b", buffering=0) if hasattr(os, "memfd_create") else tempfile.TemporaryFile(buffering=0) for n in ("order", "lcp", "columns"))
        self.rows = 0

    def __enter__(self) -> ColumnFiles:
        return self

    def __exit__(self, *_: object) -> None:
        for f in (self.order, self.lcp, self.columns):
            f.close()

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        out = np.empty(self.rows, np.int32), np.empty(self.rows, np.uint16)
        for f, values in zip((self.order, self.lcp), out, strict=True):
            f.seek(0)
            view, at = memoryview(values).cast("B"), 0
            while at < len(view):
                at += f.readinto(view[at:])
        return out

    def write(self, order: np.ndarray, lcp: np.ndarray, symbols: np.ndarray) -> None:
        self.rows = len(order)
        self.order.seek(0)
        self.lcp.seek(0)
        for f, values in ((self.order, order.astype(np.int32)), (self.lcp, lcp), (self.columns, symbols)):
            view = memoryview(np.ascontiguousarray(values)).cast("B")
            while len(view):
                view = view[f.write(view) :]


def _least(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minimum of values[left .. right], both included, from a table of minima over powers of two."""
    out = np.empty(len(left), values.dtype)
    length = right - left + 1
    level = np.frexp(length.astype(np.float64))[1] - 1
    now, k = values, 0
    while True:
        here = np.flatnonzero(level == k)
        out[here] = np.minimum(now[left[here]], now[right[here] - (1 << k) + 1])
        if k >= level.max(initial=0):
            return out
        now = np.minimum(now[: len(now) - (1 << k)], now[1 << k :])
        k += 1


def repeated_windows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, before: np.ndarray, width: int) -> np.ndarray:
    """One flag for each window of each string, in order: it occurs in another string at the same place from the minimizer.

    data: bytes of all strings; before: bytes of each string in front of its minimizer.
    """
    windows = np.concatenate([[0], np.cumsum(lengths - width + 1)])
    flags = np.zeros(windows[-1], bool)
    left, right = -before, lengths - before - 1
    joining = np.argsort(-right, kind="stable")
    joins = -right[joining]
    with ColumnFiles() as files:
        for column in range(int(right.max()), int(left.min()) - 1, -1):
            order, lcp = files.read()
            stays = left[order] <= column
            if not stays.all():
                kept = np.flatnonzero(stays)
                lcp = np.minimum.reduceat(lcp[: kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1])) if len(kept) else lcp[:0]
                order = order[kept]
                lcp[:1] = 0
            a, b = np.searchsorted(joins, [-column, -column + 1])
            order = np.concatenate([joining[a:b], order])
            lcp = np.concatenate([np.zeros(b - a, np.uint16), lcp])
            symbols = data[starts[order] + (column - left[order])]
            moved = np.argsort(symbols, kind="stable")
            order, symbols = order[moved], symbols[moved]
            same = np.flatnonzero(symbols[1:] == symbols[:-1])
            shared = np.zeros(len(order), np.uint16)
            if len(same):
                shared[same + 1] = _least(lcp, moved[same] + 1, moved[same + 1]) + np.uint16(1)
            files.write(order, shared, symbols)
            hit = shared >= width
            hit[:-1] |= hit[1:]
            found = order[hit]
            flags[windows[found] + (column - left[found])] = True
    return flags


def spans_of(flags: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Byte spans that the flagged windows cover, joined where they touch."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > width) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(at) - 1]])
    return [(int(at[a]), int(at[b]) + width) for a, b in zip(first, last, strict=True)]


def _pieces(raw: np.ndarray, at: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """Runs of whole rows; a row beyond a piece's size comes as overlapping pieces of its own. (first row, row after the
    last, bytes, offsets, bytes of the row before the piece)"""
    for a, b, part, offsets in runs(raw, at):
        if b - a > 1 or len(part) <= PIECE_WINDOWS + width - 1:
            yield a, b, part, offsets, 0
            continue
        for k in range(0, len(part) - width + 1, PIECE_WINDOWS):
            piece = part[k : k + PIECE_WINDOWS + width - 1]
            yield a, b, piece, np.array([0, len(piece)]), k


def _runs_of(texts: pa.Array, width: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each piece: row, start in the row, windows, minimizer, content hash, bytes before the minimizer; the piece's bytes, and where each run begins in them."""
    raw, at = buffers(texts)
    for a, _, part, offsets, skipped in _pieces(raw, at, width):
        row, start, n, key, before = super_runs(part, offsets, width, gram)
        content = mix(span_hashes(part, start, start + n + width - 1, lower=False) + n.astype(np.uint64) * np.uint64(1009) + before.astype(np.uint64))
        yield row + a, start - offsets[row] + skipped, n, key, content, before, part, start


class Bitmap:
    """A set of hashed keys that may hold others too. Its size follows the number of keys up to MOST_SLOTS bits; the
    bits are gathered on the executors, 4 KB for each 32,768 slots, so that is all that the driver gets."""

    def __init__(self, keys: DataFrame, *cols: str) -> None:
        """keys: a written table; cols: its long columns that make a key."""
        n = keys.count() * SLOTS_A_KEY
        slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << max(0, n - 1).bit_length()))
        self.mask = np.uint64(slots - 1)
        self.bits = np.zeros(slots // 8, np.uint8)
        one = self.__class__.slot

        def slots_of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(one(slots - 1, *(c.to_numpy() for c in batch.columns))) + 1)], names=["slot"])

        chunks = keys.select(*cols).mapInArrow(slots_of, "slot long").groupBy(F.bitmap_bucket_number("slot").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        for k, bits in zip(*(c.to_pylist() for c in chunks.toArrow().columns), strict=True):
            own = np.frombuffer(bits, np.uint8)[: len(self.bits)]
            self.bits[(k - 1) * 4096 : (k - 1) * 4096 + len(own)] = own

    @staticmethod
    def slot(mask: int, *parts: np.ndarray) -> np.ndarray:
        h = np.zeros(len(parts[0]), np.uint64)
        for p in parts:
            h = mix(h + p.view(np.uint64))
        return (h & np.uint64(mask)).astype(np.int64)

    def has(self, *parts: np.ndarray) -> np.ndarray:
        slot = self.slot(int(self.mask), *parts)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM, most_strings: int = MOST_STRINGS) -> DataFrame:
    """One row per input row: doc_id, kept (binary), n_bytes, spans (array of removed [start, end) in bytes).

    Every byte is removed that a string of `width` bytes covers which also starts anywhere else, in another text or the
    same. Texts are UTF-8 bytes; a null text is empty; texts shorter than `width` stay whole. Repeated rows are repeats of
    each other, with equal ids or not; a null id is an id like any other. Ids must be of a whole-number type. Other columns are ignored, and an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    texts = docs.select(F.coalesce(whole_id(docs, id_col), F.lit(-(1 << 63))).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"))

    def minimizers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keys = [x[3] for x in _runs_of(batch.column(0), width, gram)]
            if keys:
                keys, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["h", "n"])

    counted = texts.select("text").mapInArrow(minimizers, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    twice = spark.sparkContext.broadcast(Bitmap(scratch.write(counted, "twice"), "h"))

    def occurrences(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, th = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for row, start, n, key, content, _, _, _ in _runs_of(batch.column(1), width, gram):
                keep = twice.value.has(key)
                yield pa.RecordBatch.from_arrays([pa.array(x[keep].view(np.int64)) for x in (key, content, ids[row], th[row], start.astype(np.int64), n.astype(np.int64))], names=["h", "c", "id", "th", "start", "n"])

    placed = scratch.write(texts.mapInArrow(occurrences, "h long, c long, id long, th long, start long, n long"), "occurrences")
    classes = placed.groupBy("h", "c").agg(F.count("*").alias("copies"), F.min(F.struct("id", "th", "start")).alias("rep"), F.first("n").alias("n"))
    classes = scratch.write(classes, "classes")
    several = scratch.write(classes.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), "several")
    wanted = scratch.write(join_counted(classes.select("h", "c", "rep.*"), several.withColumn("many", F.col("k") > most_strings), ["h"], "k"), "wanted")
    reps = spark.sparkContext.broadcast(Bitmap(wanted, "th", "start"))

    def strings(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, th = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for row, start, n, _, _, before, part, at in _runs_of(batch.column(1), width, gram):
                keep = np.flatnonzero(reps.value.has(th[row], start.astype(np.int64)))
                data = [part[a:b].tobytes() for a, b in zip(at[keep], at[keep] + n[keep] + width - 1, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[row[keep]]), pa.array(th[row[keep]]), pa.array(start[keep].astype(np.int64)), pa.array(before[keep].astype(np.int32)), pa.array(data, pa.binary())], names=["id", "th", "start", "before", "data"])

    found = texts.mapInArrow(strings, "id long, th long, start long, before int, data binary")
    collections = wanted.join(found, ["id", "th", "start"]).select("h", "c", "before", "data", "many")
    if several.where(F.col("k") > most_strings).head(1):
        collections = scratch.write(collections, "strings")

    def transform(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            c = t["c"].to_numpy()
            again = (c[1:] == c[:-1]) & (np.diff(t["h"].to_numpy()) == 0)  # rows repeated in the input give their string twice
            t = t.take(np.flatnonzero(np.concatenate([[True], ~again]))).combine_chunks()
            data = t["data"].combine_chunks()
            raw, at = buffers(data)
            before = t["before"].to_numpy().astype(np.int64)
            lengths = np.diff(at)
            flags = repeated_windows(raw, at[:-1], lengths, before, width)
            ends = np.cumsum(lengths - width + 1)
            spans = [spans_of(flags[b - k : b], width) for b, k in zip(ends, lengths - width + 1, strict=True)]
            some = [k for k, s in enumerate(spans) if s]
            return pa.RecordBatch.from_arrays([t["h"].take(some).combine_chunks(), t["c"].take(some).combine_chunks(), pa.array([[{"a": a, "b": b} for a, b in spans[k]] for k in some], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], names=["h", "c", "spans"])

        held, size = [], 0
        for batch in it:
            h = batch.column(0).to_numpy()
            change = np.flatnonzero(np.diff(h)) + 1
            begin = 0
            for cut in [*change, len(h)]:
                part = batch.slice(begin, cut - begin)
                if size >= COLLECTION_BYTES and held and held[-1].column(0)[-1].as_py() != h[begin]:
                    yield done(held)
                    held, size = [], 0
                held.append(part)
                size += part.column(3).slice(0, len(part)).nbytes
                begin = cut
        if held:
            yield done(held)

    schema = "h long, c long, spans array<struct<a: long, b: long>>"
    by_files = collections.where("not many").select("h", "c", "before", "data").repartition("h").sortWithinPartitions("h", "c").mapInArrow(transform, schema)

    def windows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            h, c, before = (batch.column(k).to_numpy() for k in range(3))
            raw, at = buffers(batch.column(3))
            n = np.maximum(0, np.diff(at) - width + 1)
            row = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            begin = at[row] + place
            one = span_hashes(raw, begin, begin + width, lower=False)
            two = mix(one ^ (place - before[row]).astype(np.uint64))  # equal windows stand at equal places from the minimizer
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h[row], two.view(np.int64), c[row], place)], names=["h", "w", "c", "place"])

    if several.where(F.col("k") > most_strings).head(1):
        cut_up = scratch.write(collections.where("many").dropDuplicates(["h", "c"]).select("h", "c", "before", "data").mapInArrow(windows, "h long, w long, c long, place long"), "windows")
        shared = scratch.write(cut_up.groupBy("h", "w").agg(F.count("*").alias("n")).where("n > 1"), "shared")
        hits = join_counted(cut_up, shared, ["h", "w"], "n").groupBy("h", "c").agg(F.collect_set("place").alias("places"))
        spans = F.transform(F.array_sort("places"), lambda p: F.struct(p.alias("a"), (p + width).alias("b")))
        by_files = by_files.union(hits.select("h", "c", spans.alias("spans")))
    copied = classes.where("copies > 1").select("h", "c", F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.col("n") + (width - 1)).alias("b"))).alias("spans"), "copies")
    verdicts = scratch.write(by_files.join(copied.select("h", "c"), ["h", "c"], "left_anti").withColumn("copies", F.lit(1).cast("long")).union(copied), "verdicts")
    removed = join_counted(placed, verdicts, ["h", "c"], "copies").select("id", "th", F.explode(F.transform("spans", lambda s: F.struct((s["a"] + F.col("start")).alias("a"), (s["b"] + F.col("start")).alias("b")))).alias("span"))
    by_text = scratch.write(removed.groupBy("id", "th").agg(F.collect_set("span").alias("removed")), "removed")

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in it:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                kept, sizes, all_spans = [], [], []
                for text, spans in zip(part.column(1), part.column(2).to_pylist(), strict=True):
                    data = (text.as_py() or "").encode()
                    joined: list[list[int]] = []
                    for s in sorted((s["a"], s["b"]) for s in spans or ()):
                        if joined and s[0] <= joined[-1][1]:
                            joined[-1][1] = max(joined[-1][1], s[1])
                        else:
                            joined.append(list(s))
                    edges = [0, *(x for s in joined for x in s), len(data)]
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    sizes.append(len(data))
                    all_spans.append([{"start": a, "end": b} for a, b in joined])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(all_spans, kind)], names=["doc_id", "kept", "n_bytes", "spans"])

    joined = texts.join(by_text, ["id", "th"], "left").select("id", "text", "removed")
    out = joined.mapInArrow(cut, "doc_id long, kept binary, n_bytes long, spans array<struct<start: long, end: long>>")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")))


def digests(removed: DataFrame) -> DataFrame:
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return removed.select("doc_id", "n_bytes", n.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(remove_repeats(table(spark, sf_dir, "documents")))


def brute_force(texts: list[bytes], width: int = WIDTH) -> list[list[tuple[int, int]]]:
    """Removed spans of each text, by a table of all windows. For tests."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - width + 1):
            h = hashlib.blake2b(t[i : i + width], digest_size=12).digest()
            seen[h] = seen.get(h, 0) + 1
    return [spans_of(np.array([seen[hashlib.blake2b(t[i : i + width], digest_size=12).digest()] > 1 for i in range(max(0, len(t) - width + 1))], bool), width) for t in texts]
