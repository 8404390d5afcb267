"""Poems from XML: a volume of items, and single encoded records."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text

#: All strings, so that numbers in the text stay as they are written.
ITEM = "_nro string, _y string, META struct<OSA:string, ID:string, LOC:string, COL:string, SGN:string, INF:string>, TEXT struct<V:array<string>, L:array<string>>"
LINE = "struct<number:int, source:string, normalized:string>"
RECORD = f"electronic_id string, poem_number int, urn string, title string, language string, script string, dialect string, lines array<{LINE}>, part string, signum string, collector string, performer string, year string, region string, place string, village string, problem string"
_SPACE = re.compile(r"[\s﻿]+")


def volume_items(volumes: DataFrame, xml_col: str = "xml") -> DataFrame:
    """(ordinal from 1, xml, electronic_id, item): each item with its exact characters and its parsed form."""
    found = F.regexp_extract_all(F.col(xml_col), F.lit(r"<ITEM\b(?s:.*?)</ITEM>"), 0)
    items = volumes.select(F.posexplode(found).alias("_k", "xml"))
    items = items.withColumn("item", F.from_xml("xml", ITEM, {"rowTag": "ITEM", "mode": "PERMISSIVE"}))
    return items.select((F.col("_k") + 1).alias("ordinal"), "xml", F.col("item._nro").alias("electronic_id"), "item")


def volume_poems(items: DataFrame) -> DataFrame:
    """Poems of volume items: numbered lines (V, or else L), citation and metadata; problem says why one can't be used."""
    text = F.coalesce(F.col("item.TEXT.V"), F.col("item.TEXT.L"))
    lines = F.transform(text, lambda v, i: F.struct((i + 1).alias("number"), clean_text(v).alias("source"), clean_text(v).alias("normalized")))
    number = F.regexp_extract(F.col("item.META.ID"), r"^\s*(\d+)", 1).try_cast("int")
    tidy = lambda c: F.nullif(clean_text(F.col(c)), F.lit(""))
    problem = (
        F.when(F.col("electronic_id").isNull(), "no electronic id")
        .when(F.coalesce(F.size("lines"), F.lit(0)) < 1, "no citable lines")
        .when(F.exists("lines", lambda x: F.coalesce(x["source"], F.lit("")) == ""), "a line has no text")
        .when(F.col("poem_number").isNull(), "no printed number")
    )
    out = items.withColumn("lines", lines).withColumn("poem_number", number)
    return out.select("ordinal", "electronic_id", "poem_number", "lines", F.coalesce(tidy("item.META.OSA"), F.lit("I1")).alias("part"), tidy("item.META.SGN").alias("signum"), tidy("item.META.COL").alias("collector"), tidy("item.META.INF").alias("performer"), F.nullif(F.col("item._y"), F.lit("")).alias("year"), tidy("item.META.LOC").alias("region"), F.sha2("xml", 256).alias("sha256"), problem.alias("problem"))


def _tag(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def _tidy(s: str) -> str:
    return _SPACE.sub(" ", html.unescape(s)).strip()


def _text(e: ET.Element, skipped: str) -> str:
    """Text in document order; of a pair of readings the skipped one is left out."""
    parts = [e.text or ""]
    for child in e:
        if _tag(child) != skipped:
            parts.append(_text(child, skipped))
        parts.append(child.tail or "")
    return "".join(parts)


def parse_record(xml: str | bytes, expected: str) -> dict[str, Any]:
    """One encoded record; `problem` is set when it is malformed, is another record, or has no usable lines."""
    none: dict[str, Any] = dict.fromkeys((c.split()[0] for c in re.sub(r"array<.*?>>", "array", RECORD).split(", ")))
    none["electronic_id"] = expected
    try:
        root = ET.fromstring(xml)
    except ET.ParseError as e:
        return none | {"problem": f"malformed: {e}"}
    attributes = {k.rpartition("}")[2]: v for k, v in root.attrib.items()}
    named = lambda name: [e for e in root.iter() if _tag(e) == name]
    first = lambda *names: next((t for n in names for e in named(n) if (t := _tidy(_text(e, "reg")))), None)
    typed = lambda name, kinds: next((t for e in named(name) if (e.get("unit") or e.get("type")) in kinds and (t := _tidy(_text(e, "reg")))), None)
    numbers = [_tidy(_text(e, "reg")) for e in named("idno")]
    if expected not in {attributes.get("id"), *numbers}:
        return none | {"problem": "another record"}
    lines, before = [], 0
    for e in named("l"):
        n = (e.get("n") or "").strip()
        line = {"number": int(n) if n.isdigit() else 0, "source": _tidy(_text(e, "reg")), "normalized": _tidy(_text(e, "orig"))}
        if line["number"] < 1 or not line["source"] or not line["normalized"]:
            return none | {"problem": "a line has no number or text"}
        if line["number"] <= before:
            return none | {"problem": "line numbers don't increase"}
        before = line["number"]
        lines.append(line)
    urn = next((x for x in numbers if x.lower().startswith("urn:")), None)
    if not lines or not urn:
        return none | {"problem": "no citable lines" if not lines else "no persistent name"}
    number = int(expected[7:11]) if expected[7:11].isdigit() else None
    language = next(iter(named("language")), None)
    tag = (language.get("ident") if language is not None else None) or attributes.get("lang") or "krl"
    dialect = _tidy(_text(language, "reg")) or None if language is not None else None
    return none | {
        "poem_number": number, "urn": urn, "title": first("head") or f"SKVR I1 {number}", "language": tag, "script": "Latn", "dialect": dialect, "lines": lines, "part": typed("biblScope", {"part"}) or "I1",
        "signum": typed("idno", {"sgn", "signum"}), "collector": first("collector"), "performer": first("performer", "informant"), "year": first("dateSt", "date"), "region": first("region"), "place": first("place"), "village": first("village"),
    }


def encoded_records(records: DataFrame, id_col: str = "electronic_id", xml_col: str = "xml") -> DataFrame:
    """Parsed records; mixed content needs a parser in document order, so this runs in Arrow-fed Python workers."""
    import pyarrow as pa

    def batches(it):
        for batch in it:
            rows = [parse_record(x or "", i or "") for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    line = pa.struct([("number", pa.int32()), ("source", pa.string()), ("normalized", pa.string())])
    kinds = {"poem_number": pa.int32(), "lines": pa.list_(line)}
    names = [c.split()[0] for c in re.sub(r"array<.*?>>", "array", RECORD).split(", ")]
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
    return records.select(id_col, xml_col).mapInArrow(batches, RECORD)
