"""Passages against a plain packer, on texts with paragraphs, odd white space and lone marks; jumps; long texts."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from corvane.functions.arrays import running
from corvane.functions.text import WS, WS_SET, word_count
from corvane.operators.passages import follow, passages

S = f"[{re.escape(WS_SET)}]"


def words(x):
    return len(re.findall(f"{S}+", x)) + 1


def spans(pattern, text, at=0):
    """Trimmed matches of the last group that aren't blank."""
    for m in re.finditer(pattern, text):
        piece = m[m.lastindex or 0]
        start = m.start(m.lastindex or 0) + len(piece) - len(piece.lstrip(WS_SET))
        if body := piece.strip(WS_SET):
            yield at + start, at + start + len(body)


def plain(text, most, least):
    pieces = []
    for a, z in spans(rf"(?:^|\n{S}*\n)([^\n](?:.|\n)*?)(?=\n{S}*\n|\Z)", text):
        group: list[tuple[int, int]] = []
        if words(text[a:z]) <= most:
            pieces.append((a, z))
            continue
        for s in spans(rf"[^.!?]+(?:[.!?]+[\"']?|\Z){S}*", text[a:z], a):
            if group and sum(words(text[b:e]) for b, e in [*group, s]) > most:
                pieces.append((group[0][0], group[-1][1]))
                group = []
            group.append(s)
        if group:
            pieces.append((group[0][0], group[-1][1]))
    out: list[tuple[int, int]] = []
    for a, z in pieces:
        if out and words(text[slice(*out[-1])]) < least and words(text[slice(*out[-1])]) + words(text[a:z]) <= most:
            out[-1] = (out[-1][0], z)
        else:
            out.append((a, z))
    return out


@pytest.mark.parametrize(("most", "least"), [(220, 55), (6, 3), (3, 3), (1, 1), (12, 0)])
def test_passages_against_a_plain_packer(spark, most, least):
    rng = random.Random(most)
    parts = ["word", "two words", "é", "😀", ".", "!", "?", '."', ".'", " ", " ", " ", "  ", "\n", "\n\n", "\n \n", "\n\n\n", " ", "\t", "Mr.", "end. ", "a b c d e f g."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += [" ".join(rng.choice(["word", "words.", "more!", "so?\n\n"]) for _ in range(1500)) for _ in range(4)] + ["", " \n ", ".", "...", "\nfirst\n\nsecond", "x" * 3000, "no end " * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionAll(spark.createDataFrame([(-1, None)], "doc_id long, text string"))
    got: dict[int, list] = {}
    for r in passages(docs, most=most, least=least).orderBy("doc_id", "ordinal").collect():
        assert r["text"] == texts[r["doc_id"]][r["start"] : r["end"]]
        got.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    for k, text in enumerate(texts):
        assert got.get(k, []) == plain(text, most, least), repr(text)
    assert -1 not in got


def test_jumps(spark):
    rng = random.Random(6)
    tables = [[rng.randrange(i + 1, min(n, i + 1 + step) + 1) for i in range(n)] for n in (0, 1, 2, 3, 7, 8, 9, 64, 1000) for step in (1, 3, 50)]
    rows = follow(spark.createDataFrame([(k, t) for k, t in enumerate(tables)], "k int, jumps array<int>"), "places", "jumps").collect()
    for r in rows:
        at, places = 0, []
        while at < len(tables[r["k"]]):
            places.append(at)
            at = tables[r["k"]][at]
        assert r["places"] == places
    values = [[rng.randrange(9) for _ in range(n)] for n in (0, 1, 2, 5, 30, 400)]
    for r in spark.createDataFrame([(v,) for v in values], "v array<int>").select("v", running(F.col("v")).alias("s")).collect():
        assert r["s"] == [sum(r["v"][:i]) for i in range(len(r["v"]))]


def test_a_long_text_costs_in_proportion(spark, tmp_path):
    took = []
    for n in (4_000, 4_000, 64_000):
        spark.createDataFrame([(1, "Some words stand in this sentence here. " * n)], "doc_id long, text string").write.mode("overwrite").parquet(str(tmp_path / "t"))
        began = time.time()
        found = passages(spark.read.parquet(str(tmp_path / "t"))).select("start", "end").collect()
        took.append(time.time() - began)
        assert len(found) == -(-n // 31)
    assert took[2] < 60


def test_passages_tell_their_words(spark):
    rng = random.Random(8)
    parts = ["word", "é", ".", "!", '."', " ", "\u2003", "\ufeff", "\x85", "\n", "\n\n", "\n \n", "x.y ", ". . "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(120))) for _ in range(300)] + ["\nfirst here\n\nsecond", "one two. " * 900, "par here\n\n" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for most, least in ((220, 55), (4, 2)):
        found = passages(docs, most=most, least=least).select("words", word_count(F.col("text")).alias("counted")).collect()
        assert len(found) > 200 and all(r["words"] == r["counted"] for r in found)


def test_passages_cost_a_few_times_what_counting_words_costs(spark):
    sentences = "Words stand here. So do others, and more. Who? They do. Lines end\nas well. "
    docs = spark.range(0, 1200, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit(sentences), 160), F.col("id").cast("string")).alias("text"))

    def seconds(rows):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            rows().collect()
            took.append(time.perf_counter() - began)
        return min(took)

    counted = seconds(lambda: docs.agg(F.sum(F.regexp_count("text", F.lit(f"{WS}+")))))
    assert seconds(lambda: passages(docs).agg(F.count("*"), F.sum("end"))) < 6 * counted


def test_a_long_blank_end_costs_in_proportion(spark):
    docs = spark.createDataFrame([(1, "x" + "\n" * 30_000), (2, "\n" * 30_000)], "doc_id long, text string")
    began = time.time()
    assert [tuple(r) for r in passages(docs).select("doc_id", "start", "end").collect()] == [(1, 0, 1)]
    assert time.time() - began < 15
