"""XML volumes by byte ranges: equal items at any range, malformed volumes refused."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from corvane.sources import xml
from corvane.sources.volumes import MalformedVolume, Volumes


@pytest.fixture
def ranges(spark):
    held = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", held[0])
    spark.conf.set("spark.sql.files.openCostInBytes", held[1])


def poem(k, rng):
    lines = "".join(f"<V>säe {rng.choice(['äiti', '&amp;', '</V><V>', '😀', 'a&lt;b'])} {i}</V>{rng.choice(['', chr(10), '  '])}" for i in range(rng.randrange(1, 9)))
    return f'<ITEM nro="skvr{k:04}" y="18{k % 100:02}"{rng.choice(["", " "])}><META><ID>{k}.</ID><LOC>Vuokkiniemi</LOC></META><TEXT>{lines}</TEXT></ITEM>'


def volume(n, seed=1):
    rng = random.Random(seed)
    return '<?xml version="1.0" encoding="UTF-8"?>\n<KOKOELMA osa="I1">\n' + "".join(poem(k, rng) + rng.choice(["\n", "", "\n<!-- note -->\n", "   "]) for k in range(n)) + "</KOKOELMA>\n"


@pytest.mark.parametrize("size", [37, 64, 501, 4096, 1 << 20])
def test_equal_items_at_any_range(spark, tmp_path, ranges, size):
    whole = {f"v{k}.xml": volume(n, k) for k, n in enumerate((1, 2, 40, 150))}
    whole["bom.xml"] = "﻿" + volume(5, 9)
    whole["tight.xml"] = volume(3, 4).rstrip("\n")
    for name, text in whole.items():
        (tmp_path / name).write_bytes(text.encode())
    got = Volumes(spark, f"file://{tmp_path}", range_bytes=size).items().collect()
    found: dict[str, list] = {}
    for r in sorted(got, key=lambda r: (r["file"], r["ordinal"])):
        found.setdefault(r["file"].rsplit("/", 1)[-1], []).append((r["ordinal"], r["xml"], r["electronic_id"]))
    assert found == {name: [(k, m[0], re.search('nro="([^"]*)', m[0])[1]) for k, m in enumerate(re.finditer(r"<ITEM\b(?:.|\n)*?</ITEM>", text), 1)] for name, text in whole.items()}


def test_exact_bytes_and_poems(spark, tmp_path):
    text = volume(20)
    (tmp_path / "v.xml").write_bytes(text.encode())
    items = Volumes(spark, f"file://{tmp_path}/v.xml").items()
    assert items.agg(F.min(F.expr(f"instr('{text.replace(chr(39), chr(92) + chr(39))}', xml) > 0").cast("int"))).first()[0] == 1
    poems = xml.volume_poems(items).orderBy("ordinal").collect()
    assert [r["electronic_id"] for r in poems] == [f"skvr{k:04}" for k in range(20)] and all(r["lines"] for r in poems)


GOOD = volume(6)


@pytest.mark.parametrize(("check", "text"), [
    ("end-without-item", GOOD.replace("</KOKOELMA>", "</ITEM></KOKOELMA>")),
    ("item-without-end", GOOD.replace("</KOKOELMA>", '<ITEM nro="x"></KOKOELMA>')),
    ("item-in-item", GOOD.replace("<META>", '<ITEM nro="y"><META>', 1)),
    ("malformed-item", GOOD.replace("</META>", "</META><TEXT", 1)),
    ("malformed-item", GOOD.replace("</LOC>", "</COL>", 1)),
    ("no-id", GOOD.replace('nro="skvr0003"', 'nro=""')),
    ("no-id", GOOD.replace('nro="skvr0003"', 'n="3"')),
    ("text-between-items", GOOD.replace("</ITEM>", "</ITEM> stray ", 1)),
    ("malformed-root", GOOD.replace("</KOKOELMA>", "</OTHER>")),
    ("malformed-root", GOOD.replace("</KOKOELMA>", "")),
    ("malformed-root", GOOD.replace('<KOKOELMA osa="I1">', "")),
    ("no-items", "<KOKOELMA></KOKOELMA>"),
])
def test_malformed_volumes_are_refused(spark, tmp_path, ranges, check, text):
    (tmp_path / "good.xml").write_bytes(GOOD.encode())
    (tmp_path / "v.xml").write_bytes(text.encode())
    volumes = Volumes(spark, f"file://{tmp_path}", range_bytes=200)
    assert check in {r["check"] for r in volumes.faults().collect()}
    assert {r["key"].rsplit("/", 1)[-1] for r in volumes.faults().collect()} == {"v.xml"}
    with pytest.raises(MalformedVolume, match="v.xml"):
        volumes.items()
