"""Records as ordered lines, in one file or a list of files, without one task or the driver passing them all.

Lines are range-partitioned by their sort key and sorted inside each range; the files' names are in the ranges' order, so
the list of files, read one after the other, is the document. Sums of bytes over the ranges, and inside each over its
lines, say where each line stands in that document; so any task can write its lines into one file at their place, and
the bytes are the same however many ranges there were. Lines of equal keys stand in the order of their bytes.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import icu_order
from ..session import kept

#: Lines in one range, and the most ranges: what the driver holds are two numbers for each.
LINES_A_RANGE, MOST_RANGES = 100_000, 10_000


def _order(rows: DataFrame, order: tuple[str, ...], collated: bool) -> list[Column]:
    """Columns to sort by; collated: by the first of them that is not null, as ICU's root collation sorts it, then by all."""
    plain = [F.col(c) for c in order]
    return [icu_order(*[c.cast("string") for c in plain]), *plain] if collated else plain


def ordered_lines(rows: DataFrame, *order: str, collated: bool = False, ranges: int | None = None) -> DataFrame:
    """(part, place, line): the rows as JSON without nulls, ranged and sorted, written once to the shared folder. place is the place
    in the part, from 0."""
    keys = _order(rows, order, collated)
    lines = rows.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)], F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("line"))
    names = [c for c in lines.columns]
    n = ranges or min(MOST_RANGES, max(1, -(-rows.count() // LINES_A_RANGE)))
    at = F.monotonically_increasing_id()  # the partition, and the place in it in the lower 33 bits
    ranged = lines.repartitionByRange(n, *names).sortWithinPartitions(*names)
    return kept(ranged.select(F.shiftright(at, 33).cast("int").alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"), "line"), "lines")


def _starts(lines: DataFrame) -> tuple[DataFrame, int, int]:
    """(part, start) of the parts, bytes in all, and lines in all."""
    sizes = sorted((r["part"], r["bytes"], r["n"]) for r in lines.groupBy("part").agg(F.sum(F.octet_length("line") + 1).alias("bytes"), F.count("*").alias("n")).collect())
    starts = list(itertools.accumulate((b for _, b, _ in sizes), initial=0))
    spark = lines.sparkSession
    return F.broadcast(spark.createDataFrame([(p, s) for (p, _, _), s in zip(sizes, starts, strict=False)], "part int, start long")), starts[-1], sum(n for *_, n in sizes)


def placed_lines(lines: DataFrame) -> tuple[DataFrame, int, int]:
    """(at, line): the byte at which each line begins, and the bytes and lines of the whole document."""
    from pyspark.sql import Window

    starts, size, n = _starts(lines)
    before = F.sum(F.octet_length("line") + 1).over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    own = lines.withColumn("own", F.coalesce(before, F.lit(0)))  # a part has a bounded number of lines
    return own.join(starts, "part").select((F.col("start") + F.col("own")).alias("at"), "line"), size, n


def _write_at(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    written = 0
    file = os.open(path, os.O_WRONLY)
    try:
        for batch in batches:
            lines = sorted(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            k = 0
            while k < len(lines):  # neighbours go out together
                start, out = lines[k][0], bytearray()
                while k < len(lines) and lines[k][0] == start + len(out):
                    out += lines[k][1].encode() + b"\n"
                    k += 1
                view = memoryview(out)
                while view:
                    done = os.pwrite(file, view, start)
                    start, view, written = start + done, view[done:], written + done
        os.fsync(file)
    finally:
        os.close(file)
    yield pa.record_batch({"written": pa.array([written], pa.int64())})


def write_file(rows: DataFrame, path: str | Path, *order: str, collated: bool = False, ranges: int | None = None) -> int:
    """One file of ordered lines, written by all tasks at their places; gives the number of lines. The path must be in a folder that
    driver and executors share, must not exist, and appears under its name when it is whole. A task that is run again
    writes the same bytes to the same place."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.exists():
        raise FileExistsError(path)
    placed, size, n = placed_lines(ordered_lines(rows, *order, collated=collated, ranges=ranges))
    draft = path.with_name(f".{path.name}.part")
    with draft.open("wb") as f:
        f.truncate(size)
    name = str(draft.resolve())
    written = placed.mapInArrow(lambda batches: _write_at(name, batches), "written long").agg(F.sum("written")).first()[0] or 0
    if written != size:
        raise OSError(f"{written} of {size} bytes of {path} were written")
    draft.rename(path)
    return n


def write_parts(rows: DataFrame, path: str, *order: str, collated: bool = False, ranges: int | None = None) -> DataFrame:
    """A folder of files whose names are in order; gives the list (part, start, bytes, n) that places them in the document. For stores
    in which a file can't be written at a place."""
    lines = ordered_lines(rows, *order, collated=collated, ranges=ranges)
    # one range to a file: a folder for each, in which its lines are sorted again
    lines.repartition("part").sortWithinPartitions("part", "place").select(F.lpad(F.col("part").cast("string"), 5, "0").alias("part"), F.col("line").alias("value")).write.partitionBy("part").text(path)
    starts, _, _ = _starts(lines)
    return lines.groupBy("part").agg(F.sum(F.octet_length("line") + 1).alias("bytes"), F.count("*").alias("n")).join(starts, "part").select("part", "start", "bytes", "n").orderBy("part")
