"""Books into sections: titles from the contents, headings found in the body, text and spans between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS, collapse_ws, normalize, trim_ws

#: A section's text is at least so long.
LEAST_CHARACTERS = 350


@dataclass(frozen=True)
class BookSpec:
    """Where contents and body of a book begin and end, and how its contents are set."""

    toc_start: str
    body_start: str
    toc_mode: str
    toc_end: str | None = None
    body_end: str | None = None
    skipped_headings: Sequence[str] = ()
    heading_aliases: Mapping[str, str] = field(default_factory=dict)
    stop_at_stars: bool = False
    #: Lines of the contents that are no titles, such as the book's own.
    toc_skipped: Sequence[str] = ()


def _index(text: Column, marker: str, after: Column) -> Column:
    """Characters before the first occurrence of a marker at or after a place; -1 if none."""
    return F.locate(marker, F.substr(text, after + 1)).cast("int") + F.when(F.locate(marker, F.substr(text, after + 1)) > 0, after).otherwise(0) - 1


def titles(books: DataFrame, spec: BookSpec, *, id_col: str = "book_id", text_col: str = "text") -> DataFrame:
    """(book, ordinal from 1, title) of the contents; lines that repeat the one before are dropped."""
    toc = books.select(F.col(id_col), F.col(text_col).alias("_text"))
    toc = toc.withColumn("_start", _index(F.col("_text"), spec.toc_start, F.lit(0)) + len(spec.toc_start))
    toc = toc.withColumn("_body", _index(F.col("_text"), spec.toc_end or spec.body_start, F.col("_start")))
    toc = toc.select(id_col, F.substr(F.col("_text"), F.col("_start") + 1, F.col("_body") - F.col("_start")).alias("_toc"))
    if spec.toc_mode == "roman-paragraph":
        compact = trim_ws(collapse_ws(F.col("_toc")))
        found = F.regexp_extract_all(compact, F.lit(rf"(?:^|{WS})[IVXLCDM]+\.{WS}+(.+?)(?={WS}+[IVXLCDM]+\.{WS}+|NOTES AND REFERENCES|\z)"), 1)
        return toc.select(id_col, F.posexplode(found).alias("_k", "_t")).select(id_col, (F.col("_k") + 1).alias("ordinal"), F.regexp_replace(trim_ws(F.col("_t")), r"[.]+\z", "").alias("title"))
    lines = toc.select(id_col, F.posexplode(F.split("_toc", "\n")).alias("_k", "_l")).withColumn("_l", trim_ws(F.col("_l"))).where("_l <> ''")
    if spec.toc_mode == "roman-lines":
        lines = lines.withColumn("_l", F.regexp_replace("_l", rf"^[IVXLCDM]+\.{WS}+", ""))
    line = F.col("_l")
    if spec.toc_mode == "indented-titlecase":
        lines = lines.where(line.rlike("^[A-Z]") & (F.length(line) < 100))
    else:
        # Bounds and openings of lines that are no titles.
        lines = lines.where((F.length(line) >= 3) & (F.length(line) < 110) & (line == F.upper(line)) & ~line.rlike(r"^(CONTENTS|NOTES|FAIRY TALES|BY THE)") & ~line.rlike(r"^\d+\.") & ~line.isin(*spec.toc_skipped))
    order = Window.partitionBy(id_col).orderBy("_k")
    lines = lines.withColumn("_n", normalize(line)).withColumn("_p", F.lag("_n").over(order)).where(F.col("_n") != F.coalesce("_p", F.lit("")))
    return lines.select(id_col, F.row_number().over(order).alias("ordinal"), line.alias("title"))


def sections(books: DataFrame, spec: BookSpec, found: DataFrame, *, id_col: str = "book_id", text_col: str = "text", least: int = LEAST_CHARACTERS) -> DataFrame:
    """(book, ordinal, title, text, start, end): body between headings; start and end are characters of the whole text."""
    text = F.col(text_col)
    b = books.select(F.col(id_col), text.alias("_text"))
    if spec.toc_end:
        b = b.withColumn("_from", _index(F.col("_text"), spec.toc_end, _index(F.col("_text"), spec.toc_start, F.lit(0))) + len(spec.toc_end))
    else:
        b = b.withColumn("_from", _index(F.col("_text"), spec.toc_start, F.lit(0)))
    b = b.withColumn("_marker", _index(F.col("_text"), spec.body_start, F.col("_from")))
    end = _index(F.col("_text"), spec.body_end, F.col("_marker") + len(spec.body_start)) if spec.body_end else _index(F.col("_text"), "*** END OF", F.col("_marker"))
    b = b.withColumn("_end", end).withColumn("_body", F.substr(F.col("_text"), F.col("_marker") + 1, F.col("_end") - F.col("_marker")))
    by_line = Window.partitionBy(id_col).orderBy("_k")
    key = F.when(F.col("_l") != "", normalize(F.col("_l")))
    lines = b.select(id_col, F.posexplode(F.split("_body", "\n")).alias("_k", "_l"))
    # Only lengths and digests of lines move; the texts between headings are cut from the body's own row below.
    lines = lines.select(id_col, "_k", F.length("_l").alias("_n"), F.sha2(key, 256).alias("_key"))
    lines = lines.withColumn("_at", F.coalesce(F.sum(F.col("_n") + 1).over(by_line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    keys = found.withColumn("_key", normalize(F.col("title")))
    for heading in spec.skipped_headings:
        keys = keys.where(F.col("_key") != normalize(F.lit(heading)))
    once = Window.partitionBy(id_col, "_key").orderBy(F.col("ordinal").desc())  # of equal titles the last one is the heading's
    keys = keys.withColumn("_r", F.row_number().over(once)).where("_r = 1").select(id_col, "_key", "ordinal", "title")
    for heading, title in spec.heading_aliases.items():
        keys = keys.unionByName(keys.where(F.col("_key") == normalize(F.lit(title))).withColumn("_key", normalize(F.lit(heading))))
    heads = lines.where("_key IS NOT NULL").join(keys.withColumn("_key", F.sha2("_key", 256)), [id_col, "_key"])
    heads = heads.groupBy(id_col, "ordinal").agg(F.min(F.struct("_k", "_at", "title")).alias("_h")).select(id_col, "ordinal", "_h.*")
    heads = heads.withColumn("_next", F.lead(F.struct("_k", "_at")).over(by_line))
    heads = heads.groupBy(id_col).agg(F.collect_list(F.struct("_k", "_at", "_next", "ordinal", "title")).alias("_heads"))  # no longer than the book's contents
    cut = b.select(id_col, "_marker", F.length("_body").alias("_len"), F.split("_body", "\n").alias("_lines")).join(heads, id_col)
    between = lambda h: F.array_join(F.slice("_lines", h["_k"] + 2, F.coalesce(h["_next"]["_k"], F.size("_lines")) - h["_k"] - 1), "\n")
    cut = cut.select(id_col, F.explode(F.transform("_heads", lambda h: F.struct(h["ordinal"], h["title"], between(h).alias("_raw"), (F.col("_marker") + h["_at"]).alias("start"), (F.col("_marker") + F.coalesce(h["_next"]["_at"], F.col("_len"))).alias("end")))).alias("_s"))
    out, raw = cut.select(id_col, "_s.*"), F.col("_raw")
    clean = F.regexp_replace(raw, r"(?is)\n+End of Project Gutenberg.*\z", "")
    if spec.stop_at_stars:
        clean = F.regexp_replace(clean, rf"(?s)\n{WS}*\*{{5}}{WS}*\n.*\z", "")
    clean = trim_ws(F.regexp_replace(clean, r"\n{3,}", "\n\n"))
    return out.select(id_col, "ordinal", "title", clean.alias("text"), "start", "end").where(F.length("text") >= least)
