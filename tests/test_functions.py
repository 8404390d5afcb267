from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from corvane.functions import scalar, text
from corvane.functions.vocabulary import CONCEPTS
from corvane.operators.passages import passages


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "want"), [("The “Fox—and” ‘Cat’\r\n", "the “fox—and” 'cat'"), ("  A-b_c*[d],e.;f:!? \"g\" ", "a b c d e f g"), ("x y\tz", "x y z"), ("", "")])
def test_normalize(spark, raw, want):
    assert one(spark, text.normalize(F.col("v")), v=raw) == want


def test_slug_title_excerpt(spark):
    assert one(spark, text.slugify(F.col("v")), v="The Élan's  New-Cap!") == "the-lans-new-cap"
    assert len(one(spark, text.slugify(F.col("v")), v="ab " * 80)) == 70
    assert one(spark, text.title_case(F.col("v")), v="THE KING'S (OLD) MAN-EATER—NOW") == "The King's (Old) Man-Eater—Now"
    long = "word " * 100
    assert one(spark, text.first_paragraph(F.col("v")), v="short\n\n" + long).endswith("…")
    assert one(spark, text.first_paragraph(F.col("v")), v="only this") == "only this"
    assert text.list_with_and(["a", "b", "c"]) == "a, b, and c"


def test_words_are_counted_at_the_cost_of_their_gaps(spark):
    odd = ["", " ", "a", " a\n", "a b", "\ufeffa\u00a0\u2003b\u3000", "a\x1cb \x85 c", "\U0001f600\u2028\U0001f600", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(odd)], "k int, t string")
    got = {r["k"]: r["n"] for r in rows.select("k", text.word_count(F.col("t")).alias("n")).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: 2, 8: None}

    long = spark.range(0, 64, 1, 4).select(F.repeat(F.concat(F.lit("words of about seven letters "), F.col("id").cast("string")), 8000).alias("t"))

    def seconds(c):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            long.select(c.alias("n")).agg(F.sum("n")).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    assert seconds(text.word_count(F.col("t"))) < 3 * seconds(F.regexp_count("t", F.lit(f"{text.WS}+"))) + 0.3


def test_pad_keeps_long_values(spark):
    assert one(spark, text.pad(F.col("v"), 3), v="7") == "007"
    assert one(spark, text.pad(F.col("v"), 3), v="12345") == "12345"


def test_ascii_boundary(spark):
    assert one(spark, F.col("v").rlike(text.ascii_pattern(r"\bon\b")), v="éon é")  # é is no word character here
    assert not one(spark, F.col("v").rlike(text.ascii_pattern(r"\bon\b")), v="gone")


def test_concepts_in_order_and_limited(spark):
    v = "The king and the queen saw a fox, a wolf, a bear, a raven, a monkey, a badger and a giant."
    assert one(spark, text.detect(F.col("v"), CONCEPTS["beings"]), v=v) == ["giant", "fox", "wolf", "bear", "raven", "monkey"]
    assert one(spark, text.detect(F.col("v"), CONCEPTS["roles"]), v=v) == ["king", "queen"]


@pytest.mark.parametrize(("day", "good"), [("2026-07-25", True), ("2026-02-30", False), ("2026-99-99", False), ("Sat Jul 25", False), ("2026-2-8", False), (None, False), ("2026-07-25\n", False)])
def test_iso_dates(spark, day, good):
    assert one(spark, scalar.is_iso_date(F.col("v")), v=day) is good


@pytest.mark.parametrize(("path", "good"), [("a/b.json", True), (".", False), ("foo/..", False), ("/abs", False), ("a\\b", False), ("a//b", False), ("", False), (None, False)])
def test_safe_paths(spark, path, good):
    assert one(spark, scalar.is_safe_path(F.col("v")), v=path) is good


def test_canonical_json_keeps_nulls_and_sorts(spark):
    assert one(spark, scalar.canonical_json({"b": F.col("v"), "a": F.lit(None).cast("string")}), v="x") == '{"a":null,"b":"x"}'


def test_byte_offsets(spark):
    assert one(spark, scalar.raw_byte_offset(F.col("v"), F.lit(3)), v="é\nab") == 2 + 1 + 1 + 1
    assert one(spark, scalar.js_length(F.col("v")), v="a😀") == 3


def test_floor_percentile(spark):
    rows = spark.range(62).select(scalar.floor_percentile(F.col("id"), 0.9).alias("p")).first()
    assert rows["p"] == 54
    assert spark.range(0).select(scalar.floor_percentile(F.col("id"), 0.9).alias("p")).first()["p"] == 0


def test_gates_are_closed_unless_true(spark):
    rows = spark.sql("SELECT * FROM VALUES (true), (false), (null) AS t(v)").select(scalar.gate(F.col("v")).alias("g")).collect()
    assert [r["g"] for r in rows] == [True, False, False]


def test_passages_are_slices_in_order(spark):
    short, long = "A few words here.", " ".join(f"Sentence number {i} has some seven words." for i in range(200))
    docs = spark.createDataFrame([(1, f"{short}\n\n{long}\n \n{short}"), (2, None), (3, "  \n\n "), (4, "x" * 50), (5, "word " * 300)], "doc_id long, text string")
    rows = passages(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    texts = {1: f"{short}\n\n{long}\n \n{short}", 4: "x" * 50, 5: "word " * 300}
    assert set(by) == {1, 4, 5}
    for i, found in by.items():
        found.sort(key=lambda r: r["ordinal"])
        assert [r["ordinal"] for r in found] == list(range(1, len(found) + 1))
        for a, b in zip(found, found[1:], strict=False):
            assert a["end"] <= b["start"]
        assert all(texts[i][r["start"] : r["end"]] == r["text"] for r in found)
    assert all(len(r["text"].split()) <= 220 for r in by[1])
    assert len(by[5]) == 1 and len(by[5][0]["text"].split()) == 300  # one sentence has no hard limit


def test_paragraph_edges(spark):
    texts = {1: "\nabc def", 2: "\nabc\n\nnext one", 3: "x", 4: "\n\n  one\n\n\n two \n", 5: "a\n \n\nb"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {}
    for r in passages(docs, least=0).orderBy("doc_id", "ordinal").collect():
        got.setdefault(r["doc_id"], []).append(r["text"])
    assert got == {2: ["next one"], 3: ["x"], 4: ["one", "two"], 5: ["a", "b"]}


def test_canonical_json_sorts_at_every_depth(spark):
    df = spark.createDataFrame([(([(3, {"z": 1, "a": None}), (1, None)], None),)], "x struct<z:array<struct<b:int,a:map<string,int>>>,a:string>")
    got = df.select(scalar.canonical_json({"k": F.col("x")}, {"k": df.schema["x"].dataType}).alias("j")).first()["j"]
    assert got == '{"k":{"a":null,"z":[{"a":{"a":null,"z":1},"b":3},{"a":null,"b":1}]}}'


def test_days_orders_and_digests(spark):
    rows = spark.createDataFrame([("b", None), (None, "a:1"), ("a-1", "z"), ("a_1", None), ("aa", "0"), ("A", None)], "id string, alias string")
    got = [r["v"] for r in rows.orderBy(scalar.icu_order(F.col("id"), F.col("alias"))).select(F.coalesce("id", "alias").alias("v")).collect()]
    assert got == ["A", "a_1", "a-1", "a:1", "aa", "b"]
    days = spark.sql("SELECT timestamp'2026-07-25 23:30:00' AS t, '2026-02-28' AS s, CAST(NULL AS STRING) AS n, '2026-02-30' AS bad")
    assert tuple(days.select(scalar.reviewed_on(F.col("t"), "timestamp"), scalar.reviewed_on(F.col("s"), "string"), scalar.reviewed_on(F.col("n"), "string")).first()) == ("2026-07-25", "2026-02-28", None)
    with pytest.raises(Exception, match="no ISO date"):
        days.select(scalar.reviewed_on(F.col("bad"), "string")).collect()
    assert days.select(scalar.digest_bytes(F.lit("xyz")).alias("v")).first()["v"] is None


def test_numeric_entities(spark):
    cases = {"a&#228;b": "aäb", "&#xE4;&#xe4;&#228;": "äää", "&#128512;!": "😀!", "x &#65; &amp; &lt;b&gt;": "x A & <b>", "&amp;#65;": "&#65;", "&#0;&#55296;&#x110000;": "&#0;&#55296;&#x110000;", "no & none;": "no & none;", "": "", "&#;": "&#;", "  &#32; a": "a"}
    rows = spark.createDataFrame([(k,) for k in [*cases, None]], "x string").select("x", text.clean_text(F.col("x")).alias("y")).collect()
    assert {r["x"]: r["y"] for r in rows} == cases | {None: None}


def test_canonical_tags(spark):
    cases = {"fi": True, "FI": False, "en-US": True, "en-us": False, "zh-Hant-TW": True, "zh-hant-TW": False, "sl-rozaj": True, "sl-ROZAJ": False, "krl": True, "not a tag": False, None: True}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", scalar.is_canonical_tag(F.col("x")).alias("y")).collect()
    assert {r["x"]: r["y"] for r in rows} == cases
