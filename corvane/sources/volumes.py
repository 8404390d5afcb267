"""Items of large XML volumes, read by byte ranges.

A volume is one file that may be far larger than a task should read. Spark's text reader takes the items' end tag as the
record separator, so any byte range gives whole items, found across the borders of ranges and kept byte for byte. Places
in the file come from counts for each range: no item is moved to number it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import expectations
from ..session import kept
from .xml import ITEM

#: Byte ranges that are broadcast at most; a row of them takes some hundred bytes.
MOST_BROADCAST = 100_000


class MalformedVolume(ValueError):
    """A volume breaks a rule; nothing of it is read."""


@dataclass(frozen=True)
class Volumes:
    """Volumes below a path: files of items `<tag ...>...</tag>` inside one root element. range_bytes: the most that a
    task reads; it is a setting of the session, and stays."""

    spark: SparkSession
    path: str
    tag: str = "ITEM"
    schema: str = ITEM
    id_field: str = "_nro"
    range_bytes: int | None = None

    @property
    def _end(self) -> str:
        return f"</{self.tag}>"

    def _opening(self) -> str:
        return rf"<{self.tag}(?=[\s/>])"

    def _rows(self) -> DataFrame:
        if self.range_bytes:
            self.spark.conf.set("spark.sql.files.maxPartitionBytes", str(self.range_bytes))
        rows = self.spark.read.option("lineSep", self._end).option("recursiveFileLookup", "true").text(self.path)
        at = F.col("_metadata")
        return rows.select(at["file_path"].alias("file"), at["file_size"].alias("size"), at["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), "value")

    @cached_property
    def _ranges(self) -> DataFrame:
        """For each byte range that pieces begin in the first row number, the pieces of the file before it and in all, and whether the last
        of the file has its end tag. Counted once; broadcast while there are few, which they are unless a hundred thousand tasks read."""
        ranges = self._rows().groupBy("file", "size", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes"))
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("file")
        # with an end tag after every piece, the pieces make up the file; a mark of byte order in front is not part of a piece
        rest = F.col("size") - F.sum("bytes").over(whole) - len(self._end) * F.sum("n").over(whole)
        placed = kept(ranges.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total"), rest.isin(0, 3).alias("closed")), "ranges")
        return F.broadcast(placed) if placed.count() <= MOST_BROADCAST else placed

    def pieces(self) -> DataFrame:
        """What stands up to each end tag, and after the last: (file, ordinal from 1, last, ended, lead, xml). lead is the text in front
        of the item and xml the item; ended is false for what follows the last end tag."""
        found = self._rows().drop("size").join(self._ranges, ["file", "block"])
        ordinal = F.col("before") + F.col("at") - F.col("first") + 1
        opens = F.regexp_instr("value", F.lit(self._opening()))
        return found.select(
            "file", ordinal.alias("ordinal"), (ordinal == F.col("total")).alias("last"), (F.col("closed") | (ordinal < F.col("total"))).alias("ended"),
            F.when(opens > 0, F.left("value", opens - 1)).otherwise(F.col("value")).alias("lead"),
            F.when(opens > 0, F.concat(F.substr("value", opens), F.when(F.col("closed") | (ordinal < F.col("total")), self._end).otherwise(""))).alias("xml"),
        )

    def _parsed(self, pieces: DataFrame) -> DataFrame:
        options = {"rowTag": self.tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
        return pieces.withColumn("item", F.from_xml("xml", f"{self.schema}, _bad string", options))

    def faults(self) -> DataFrame:
        """(check, key, detail) of what is wrong with the volumes; key is the file, detail the item's number."""
        pieces = self.pieces()
        parsed = self._parsed(pieces)
        blank = lambda c: F.trim(F.regexp_replace(c, r"<!--(?s:.*?)-->|\s", "")) == ""
        ended, some = F.col("ended"), F.col("xml").isNotNull()
        rules = {
            "end-without-item": ended & ~some,
            "item-without-end": ~ended & some,
            "item-in-item": ended & (F.regexp_count("xml", F.lit(self._opening())) > 1),
            "malformed-item": ended & F.col("item._bad").isNotNull(),
            "no-id": ended & (F.coalesce(F.trim(F.col(f"item.{self.id_field}")), F.lit("")) == ""),
            "text-between-items": ended & (F.col("ordinal") > 1) & ~blank(F.col("lead")),
        }
        broken = F.array_compact(F.array(*[F.when(rule, F.lit(check)) for check, rule in rules.items()]))
        items = parsed.select("file", F.col("ordinal").cast("string").alias("detail"), broken.alias("broken")).where(F.size("broken") > 0)
        shown = lambda rows, check, detail: rows.select(F.lit(check).alias("check"), F.col("file").alias("key"), detail.alias("detail"))
        checks = [items.select(F.explode("broken").alias("check"), F.col("file").alias("key"), "detail")]
        # the root: what stands before the first item and after the last, parsed together
        ends = pieces.where("ordinal = 1 OR last").groupBy("file").agg(
            F.max(F.when((F.col("ordinal") == 1) & F.col("ended"), F.col("lead"))).alias("head"),
            F.max(F.when(F.col("last") & ~F.col("ended"), F.concat("lead", F.coalesce("xml", F.lit(""))))).alias("tail"),
            F.max(F.when((F.col("ordinal") == 1) & ~F.col("ended") & F.col("xml").isNull(), F.lit(True))).alias("none"),
        )
        root = F.concat(F.coalesce("head", F.lit("")), F.coalesce("tail", F.lit("")))
        open_ = F.regexp_extract(root, r"<([A-Za-z_][^\s/>]*)", 1)
        whole = F.from_xml(root, "_bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
        checks.append(shown(ends.where("none"), "no-items", F.lit(None).cast("string")))
        checks.append(shown(ends.where(F.col("none").isNull() & ((open_ == "") | ~F.rtrim(root, F.lit(" \t\r\n")).endswith(F.concat(F.lit("</"), open_, F.lit(">"))) | whole["_bad"].isNotNull())), "malformed-root", F.lit(None).cast("string")))
        return expectations.all_of(*checks)

    def items(self) -> DataFrame:
        """(file, ordinal, xml, electronic_id, item): each item with its exact bytes and its parsed form. Refuses all volumes if one is
        malformed, has no items, or an item without an id."""
        if bad := self.faults().take(5):
            raise MalformedVolume("; ".join(f"{r['key'].rsplit('/', 1)[-1]}: {r['check']}" + (f" ({r['detail']})" if r["detail"] else "") for r in bad))
        found = self._parsed(self.pieces().where("ended"))
        return found.select("file", F.col("ordinal").cast("int").alias("ordinal"), "xml", F.trim(F.col(f"item.{self.id_field}")).alias("electronic_id"), "item")


def escaped(x: Column) -> Column:
    """Text as XML has it."""
    for raw, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        x = F.replace(x, F.lit(raw), F.lit(f"&{name};"))
    return x
