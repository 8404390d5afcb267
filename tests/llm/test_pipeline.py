"""The stages of the pipeline against brute force on a small corpus."""

from __future__ import annotations

import pytest

import corpus_pipeline
from corvane.llm import line_dedup, mixing, ngram_join

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{folder}/{name}")
        out[name] = (docs, spark.read.parquet(f"{folder}/{name}"))
        docs = out[name][1]
    return out


def test_columns(stages):
    for name, (before, after) in stages.items():
        if name != "encode":
            assert after.columns == before.columns and after.dtypes == before.dtypes


def test_toxicity_only_drops(stages):
    before, after = stages["toxicity"]
    assert after.exceptAll(before).count() == 0 and 0 < after.count() < before.count()


def test_line_dedup_drops_later_runs(stages):
    before, after = stages["line_dedup"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    got = {r["doc_id"]: r["text"] for r in after.collect()}
    seen, want, longest = set(), {}, line_dedup.RUN
    for i in sorted(texts):
        lines = texts[i].split("\n")
        inked, gone = [k for k, x in enumerate(lines) if x.split()], set()
        for p in range(len(inked)):
            for size in range(1, min(longest, len(inked) - p) + 1):
                w = tuple(lines[k] for k in inked[p : p + size])
                if size == longest or len(" ".join(w).split()) > line_dedup.WORDS:
                    if w in seen:
                        gone |= set(inked[p : p + size])
                    seen.add(w)
        want[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    assert got == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_one_of_each_group_stays(stages):
    before, after = stages["ngram_join"]
    groups = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(before, words=5, num=80).collect()}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(groups.values()))
    assert after.exceptAll(before).count() == 0


def test_mix_has_the_words(stages):
    before, after = stages["mixing"]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(before).collect() if r["taken"]}
    got: dict[int, int] = {}
    for r in after.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].split())
    assert got == taken


def test_encode_rows(stages):
    before, after = stages["encode"]
    assert after.count() == before.count() and {"doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"} == set(after.columns)


def test_run_gives_the_same(spark, stages):
    a = corpus_pipeline.run(spark, DATA).select("doc_id", "ids_sha256")
    b = stages["encode"][1].select("doc_id", "ids_sha256")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
