"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corvane.llm import cover_tree, language, line_dedup, mixing, ngram_join, pieces, quality_classifier, quality_rules, repeats, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, n long, c1 string, label string, id string, places string, text_ string"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
TEXTS = [None, "", "   \n\t ", "one", "a b c", "é\n\né\n\né 你好 😀", "same line\nsecond line\nthird line\n", LONG, "123 456 !!! ###", "\x00 odd \x7f", "x" * 5000]


def rows(texts, repeat=1):
    out = []
    for k, t in enumerate(texts):
        out += [(k, t, "en", "s" if k % 2 else None, 1, 2, 0.5, 3, "c", "l", "i", "p", "t")] * repeat
    return [*out, (None, "a text without an id", None, None, *out[0][4:])] if texts else []


@pytest.fixture(scope="module")
def models(spark):
    docs = spark.createDataFrame([(i, "you stupid fool " * 5 if i % 3 == 0 else "a kind and calm sentence " * 5) for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"), (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    langs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "xx").otherwise("yy"))
    return toxicity.learn_toxicity(docs, labels), quality_classifier.learn_quality(docs, labels), language.learn_languages(langs)


def operators(models):
    toxic, quality, langs = models
    path = pieces.default_model()
    return {
        "mix": mixing.mix_sources, "mixed rows": mixing.mix_documents, "rules": quality_rules.quality_rules, "near": ngram_join.near_duplicates, "one of each": ngram_join.keep_one_of_each,
        "lines": line_dedup.drop_repeated_lines, "repeats": repeats.remove_repeats, "pieces": lambda d: pieces.encode_pieces(d, path), "toxic": lambda d: toxicity.score_toxicity(d, toxic),
        "drop toxic": lambda d: toxicity.drop_toxic(d, toxic), "quality": lambda d: quality_classifier.grade_quality(d, quality), "language": lambda d: language.identify_languages(d, langs),
    }


NAMES = ["mix", "mixed rows", "rules", "near", "one of each", "lines", "repeats", "pieces", "toxic", "drop toxic", "quality", "language"]


@pytest.mark.parametrize("name", NAMES)
def test_edge_rows(spark, models, name):
    f = operators(models)[name]
    given = rows(TEXTS, repeat=2)
    got = f(spark.createDataFrame(given, SCHEMA)).collect()
    if name in ("mixed rows", "one of each", "drop toxic"):
        assert got[0].asDict().keys() == dict.fromkeys(c.split()[0] for c in SCHEMA.split(", ")).keys()
    else:
        assert len(got) == len(given)
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in given)
    if name == "one of each":
        assert len(got) == len(TEXTS) + 1  # of two equal rows one stays; rows without words are no duplicates of others
    if name == "language":
        assert {r["lang_pred"] for r in got if r["doc_id"] in (0, 1, 2)} == {"und"}
    if name == "rules":
        assert all(r["base_failed"] and not r["kept"] for r in got if r["doc_id"] in (0, 1, 2))
    if name == "near":
        assert all(r["component_id"] == r["doc_id"] for r in got)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, models, name):
    assert operators(models)[name](spark.createDataFrame([], SCHEMA)).collect() == []


def test_models_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    docs = spark.createDataFrame(rows(["some words here", None]), SCHEMA)
    assert {r["score"] for r in toxicity.score_toxicity(docs, toxicity.learn_toxicity(none, labels)).collect()} == {0.5}
    assert {r["expected_grade"] for r in quality_classifier.grade_quality(docs, quality_classifier.learn_quality(none, labels)).collect()} == {0.0}
    assert {r["lang_pred"] for r in language.identify_languages(docs, language.learn_languages(none)).collect()} == {"und"}


def test_vectors(spark):
    nan = float("nan")
    e = [1.0, 0.0, 0.5]
    given = [(1, e, 1), (2, e, 1), (3, [2.0, 0.0, 1.0], 1), (4, e, 2), (5, e, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [nan, 1.0, 1.0], 1), (9, [None, 1.0, 1.0], 1), (10, [], 1), (11, [1.0, 0.0], 1), (None, e, 1), (12, [float("inf"), 1.0, 0.0], 1), (2, e, 1)]
    got = cover_tree.near_vectors(spark.createDataFrame([(*g, "x") for g in given], "vec_id long, embedding array<double>, label int, n string")).collect()
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    assert len(got) == len(given)
    assert by[1] == [(3, 1, True)] and by[2] == [(3, 1, False)] * 2 and by[3] == [(3, 1, False)]
    assert all(by[k] == [(0, k, True)] for k in (4, 5, 6, 7, 8, 9, 10, 11, 12)) and by[None] == [(0, None, None)]
    assert cover_tree.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


@pytest.mark.parametrize("kind", ["long", "string"])
def test_internal_names_may_be_taken(spark, kind):
    names = ["_key", "_id", "_head", "_n", "node", "own", "head", "place", "_size", "_taken", "_src", "_content", "_copy", "size", "taken", "src", "content", "copy", "key", "range", "mark", "c1", "k.x"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` {kind}" for n in names)
    given = [(i, f"alpha beta gamma delta {i // 2} epsilon zeta", "s", *[str(7 + k) if kind == "string" else 7 + k for k in range(len(names))]) for i in range(6)]
    docs = spark.createDataFrame(given, schema)
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == given[::2]
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and {tuple(r)[3:] for r in mixed.collect()} == {given[0][3:]}
    lines = line_dedup.drop_repeated_lines(docs)
    assert {tuple(r)[3:-3] for r in lines.collect()} == {given[0][3:]}


def test_ids_that_are_no_whole_numbers_are_refused(spark):
    docs = spark.createDataFrame([("a", "some text")], "doc_id string, text string")
    for f in (ngram_join.near_duplicates, ngram_join.keep_one_of_each, repeats.remove_repeats):
        with pytest.raises(TypeError, match="whole numbers"):
            f(docs)
    assert line_dedup.drop_repeated_lines(docs).first()["doc_id"] == "a"


def test_cuts_are_exact(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join("w" * rng.randrange(1, 30)), rng.choice(["a", "b", "c", None])) for i in range(400)], "doc_id long, text string, source string")
    got = mixing.mix_sources(docs, rows_a_range=8).collect()
    again = mixing.mix_sources(docs.repartition(7), rows_a_range=64).collect()
    assert sorted(got) == sorted(again)
    taken, target = {}, {}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    for r in got:
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert taken == {s: int(t) for s, t in target.items()}
    mixed = mixing.mix_documents(docs).collect()
    words = {}
    for r in mixed:
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    assert words == taken
