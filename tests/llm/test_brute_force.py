"""Operators that SQL can't express, against brute force, the library, or held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from corvane.llm import cover_tree, graph, language, line_dedup, ngram_join, pieces, quality_classifier, registry, repeats, superkmers, toxicity, wordhash
from corvane.llm.common import Scratch, fold, join_counted
from corvane.llm.terms import labelled_terms

DATA = "/root/testdata/sf0.001"


def union(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize(("k", "num", "blocks", "bucket"), [(4, 85, 1500, 100_000), (5, 80, 20, 100_000), (1, 85, 1500, 5), (4, 85, 20, 3)])
def test_near_duplicates(spark, k, num, blocks, bucket):
    rng = random.Random(k)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([6, 12, 40, 150]))]
        texts += [" ".join(edited(base, rng, rng.randrange(0, max(1, len(base) // 25)))) for _ in range(12)]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(60):
        texts.append(" ".join(chain))
        chain = edited(chain, rng, 1)
    texts += [texts[0], texts[5], "", None, "a b", "A B"]
    sets = [shingles(t, k) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    want = union(pairs, range(len(sets)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs, words=k, num=num, block_rows=blocks, bucket_rows=bucket).collect()}
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}


def test_rows_of_one_id_go_only_when_linked(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, None), (7, c), (8, c), (9, ""), (9, b + " "), (None, a)]
    kept = ngram_join.keep_one_of_each(spark.createDataFrame([*rows, (5, b)], "doc_id long, text string"))
    assert Counter(tuple(r) for r in kept.collect()) == Counter([(1, a), (5, b), (7, None), (7, c), (9, ""), (None, a)])


def test_texts_without_a_copy_are_not_shuffled(spark):
    """What is written for shuffles stays near the signatures: texts that are alone stay in place, and equal buckets are looked at once."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"{w:x}" for w in rng.integers(0, 2**60, 400)) for _ in range(300)]
    near = [t.rsplit(" ", 4)[0] for t in texts[:100]]
    docs = spark.createDataFrame(list(enumerate(texts + near)), "doc_id long, text string")
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    began = written()
    kept = sorted(r["doc_id"] for r in ngram_join.keep_one_of_each(docs).select("doc_id", "text").collect())
    assert kept == list(range(300))
    assert written() - began < 2 * sum(map(len, texts + near))


def test_packed_numbers():
    rng = np.random.default_rng(4)
    for top in (1, 200, 1 << 17, 1 << 40, 1 << 63):
        values = np.sort(rng.integers(0, top, 500, dtype=np.uint64))
        data = ngram_join.packed(values)
        assert (ngram_join.unpacked(data, 500) == values).all()
    assert len(ngram_join.packed(np.arange(500, dtype=np.uint64) * np.uint64(200))) == 500


def test_squeezed_sketches():
    rng = np.random.default_rng(8)
    for n in (1, 100, 300, 1000, 3000, 9000):
        drawn = ngram_join.sketch(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        assert zlib.decompress(ngram_join.squeezed(drawn), -15) == drawn
        assert len(ngram_join.squeezed(drawn)) < 0.7 * len(drawn)


def shuffled(spark):
    """Records that each stage so far has written for a shuffle."""
    context = spark.sparkContext
    stages = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)
    return {stages.apply(k).stageId(): stages.apply(k).shuffleWriteRecords() for k in range(stages.size())}


@pytest.mark.parametrize("part", [1 << 20, 500])
def test_signatures_of_one_class_are_not_shuffled(spark, monkeypatch, part):
    monkeypatch.setattr(ngram_join, "PART_SHINGLES", part)
    monkeypatch.setattr(ngram_join, "PACKED", 2000)
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(120)) for _ in range(200)]
    near = [t.rsplit(" ", 3)[0] for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate([*texts, *near, *texts[20:60], *texts[20:60]])), "doc_id long, text string").repartition(6)
    before = shuffled(spark)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs).collect()}
    assert got == {i: i - 200 if 200 <= i < 220 else i - 200 if 220 <= i < 260 else i - 240 if i >= 260 else i for i in range(300)}
    made = sum(n for k, n in shuffled(spark).items() if k not in before)
    assert made < 200 * 60  # each of these texts has over 100 signatures


def test_signatures_are_shared_by_all_linked_sets():
    rng = np.random.default_rng(5)
    for n in (6, 7, 9, 13, 20, 47, 300, 2000):
        for _ in range(40):
            base = rng.integers(1, 2**63, n).astype(np.uint64)
            d = int(rng.integers(0, 15 * n // 100 + 1))
            other = np.concatenate([base[d:], rng.integers(1, 2**63, int(rng.integers(0, d + 1))).astype(np.uint64)])
            inter, both = len(base) - d, len(base) + len(other) - (len(base) - d)
            if 100 * inter < 85 * both or not d:
                continue
            rows, values = wordhash.distinct(np.repeat([0, 1], [len(base), len(other)]), np.concatenate([base, other]))
            owner, s = ngram_join.signatures(rows, values, np.array([len(base), len(other)]), 85, 100)
            assert set(s[owner == 0].tolist()) & set(s[owner == 1].tolist())


@pytest.mark.parametrize("limits", [(100, 4096), (2, 4096), (2, 2)])
@pytest.mark.parametrize("n", [100, 1500, 6000])
def test_split_buckets_keeps_linked_sets_together(monkeypatch, limits, n):
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(10):
        base = rng.integers(1, 2**63, n).astype(np.uint64)
        sets += [np.unique(np.concatenate([base[: n - i % 8], rng.integers(1, 2**63, i % 8).astype(np.uint64)])) for i in range(8)]
    drawn = [ngram_join.sketch(s) for s in sets]
    size = np.array([len(s) for s in sets])
    monkeypatch.setattr(ngram_join, "ALL_PAIRS", limits[0])
    monkeypatch.setattr(ngram_join, "MATRIX_ROWS", limits[1])
    i, j = ngram_join.split_buckets(np.zeros(len(sets), np.int64), drawn, size, 85, 100)
    label = union(zip(i.tolist(), j.tolist(), strict=True), range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            inter = len(np.intersect1d(sets[a], sets[b]))
            if 100 * inter >= 85 * (len(sets[a]) + len(sets[b]) - inter):
                assert label[a] == label[b]
    assert len(set(label.values())) == 10 or limits[1] == 2


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long").repartition(5), Scratch(spark, "t"), "c").collect()}
    want = union(pairs, {x for p in pairs for x in p})
    assert {n: want[n] for n in got} == got and {n for n, label in want.items() if n != label} <= set(got)


def removed_lines(texts, run, words):
    """Places of lines that go: of every run of equal lines long enough, however long, all but the first occurrence."""
    seen, out = set(), []
    for t in texts:
        lines, gone = [x for x in (t or "").split("\n") if x.split()], set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                w = tuple(lines[a:b])
                if len(w) >= run or len(" ".join(w).split()) > words:
                    if w in seen:
                        gone |= set(range(a, b))
                    seen.add(w)
        out.append(gone)
    return out


@pytest.mark.parametrize(("run", "words"), [(3, 50), (4, 12), (1, 9), (5, 1000)])
def test_repeated_lines(spark, run, words):
    rng = random.Random(run)
    line = lambda: " ".join(f"w{rng.randrange(5)}" for _ in range(rng.choice([1, 2, 5, 11, 30, 60])))
    pool, passage = [line() for _ in range(12)], [line() for _ in range(14)]
    texts = []
    for _ in range(60):
        lines = [rng.choice(pool) if rng.random() < 0.4 else line() for _ in range(rng.randrange(0, 9))]
        cut = rng.randrange(len(passage))
        lines[len(lines) // 2 : len(lines) // 2] = passage[cut : cut + rng.randrange(8)]
        texts.append("\n".join(x for y in lines for x in (y, rng.choice(["", " "]))[: rng.randrange(1, 3)]))
    texts += [texts[3], None, "", "one line", "one line", "\n".join(passage), "\n".join(passage * 2), "x\n" * 30]
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), run=run, words=words).collect()}
    for i, (t, gone) in enumerate(zip(texts, removed_lines(texts, run, words), strict=True)):
        inked = [k for k, x in enumerate((t or "").split("\n")) if x.split()]
        out = {inked[g] for g in gone}
        assert (got[i]["n_removed"], got[i]["text"]) == (len(gone), None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in out))


def test_winnowing_selects_few_positions():
    rng = np.random.default_rng(0)
    lines, n_words = rng.integers(1, 2**63, 30_000).astype(np.uint64), np.full(30_000, 5)
    text, place, *_ = line_dedup.winnow(lines, n_words, np.array([0, 10_000, 30_000]), 3, 50)
    assert len(text) == 30_000 - 4 and 0.45 < len(set(zip(text.tolist(), place.tolist(), strict=True))) / 30_000 < 0.55


def test_hot_keys_join_like_others(spark):
    rows = spark.range(5000).select((F.col("id") % 7 * (F.col("id") % 2)).alias("k"), F.col("id").alias("v"))
    keyed = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("least")).where("k <> 3")
    for hot in (10, 1000, 10**6):
        got = join_counted(rows, keyed, ["k"], "n", hot_rows=hot, hot_keys=3)
        assert sorted(got.collect()) == sorted(rows.join(keyed.drop("n"), "k").collect())


@pytest.mark.parametrize(("width", "most"), [(20, 20_000), (50, 20_000), (20, 2), (50, 1)])
def test_repeated_bytes(spark, width, most):
    rng = random.Random(width)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 6)))
    passage = " ".join(word() for _ in range(40))
    texts = [" ".join(word() for _ in range(rng.randrange(0, 80))) for _ in range(60)]
    for k in range(0, 60, 3):
        cut = rng.randrange(len(passage) // 2)
        texts[k] += passage[cut : cut + rng.randrange(width // 2, 3 * width)] + word()
    texts += [texts[0], texts[1], "ab" * 100, "z" * 70, None, "", "é" * 33]
    spans = repeats.brute_force([(t or "").encode() for t in texts], width)
    got = {r["doc_id"]: r for r in repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width=width, gram=width // 4, most_strings=most).collect()}
    for i, (t, want) in enumerate(zip(texts, spans, strict=True)):
        data = (t or "").encode()
        edges = [0, *(x for s in want for x in s), len(data)]
        assert [(s["start"], s["end"]) for s in got[i]["spans"]] == want
        assert bytes(got[i]["kept"]) == b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) and got[i]["n_bytes"] == len(data)


def test_repeated_windows_of_strings_with_different_ends():
    width, rng = 200, np.random.default_rng(3)
    strings, before = [], []
    for _ in range(40):  # each pair begins at its own column, so some pairs leave while others still share windows
        shared = rng.integers(97, 101, int(rng.integers(220, 400))).astype(np.uint8)
        place = int(rng.integers(0, 160))
        for _ in range(2):
            left, right = (rng.integers(97, 101, int(rng.integers(0, 20))).astype(np.uint8) for _ in range(2))
            left[:1] = 122  # sorts after all strings that stay
            strings.append(np.concatenate([left, shared, right]))
            before.append(len(left) + place)
    lengths, before = np.array([len(x) for x in strings]), np.array(before)
    starts = np.cumsum(lengths) - lengths
    got = repeats.repeated_windows(np.concatenate(strings), starts, lengths, before, width)
    windows = [(k - b, x[k : k + width].tobytes()) for x, b in zip(strings, before, strict=True) for k in range(len(x) - width + 1)]
    n = Counter(windows)
    assert got.tolist() == [n[w] > 1 for w in windows]


def test_long_texts_come_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 101, 5000).astype(np.uint8)
    monkeypatch.setattr(repeats, "PIECE_WINDOWS", 700)
    seen = np.zeros(5000 - 49, int)
    for _, _, piece, offsets, skipped in repeats._pieces(raw, np.array([0, 5000]), 50):
        _, start, n, _, before = superkmers.super_runs(piece, offsets, 50, 12)
        for s, k in zip(start, n, strict=True):
            seen[skipped + s : skipped + s + k] += 1
        assert (before >= 0).all() and (before <= 38).all()
    assert (seen == 1).all()


def test_pieces_equal_the_library():
    path = pieces.default_model()
    ours, library = pieces.codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    letters = "  \n\t ▁abcthein.,é你日　😀ßI'-_0123=*#"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice(ours.pieces[259:]) for _ in range(rng.randrange(1, 7))) for _ in range(3000)]
    texts += [" " * n + "the" + " " * m for n in range(36) for m in range(36)] + ["", "a" * 400, "the" * 300, "\n" * 50, "x\x00y", "�"]
    for t in texts:
        ids = ours.encode(t)
        assert ids.tolist() == library.encode(t)
        assert ours.decode(ids) == library.decode(ids.tolist())


def test_pieces_query_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in registry.queries()["op8_sentencepiece"](spark, DATA).collect():
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    encoded = pieces.encode_pieces(spark.createDataFrame([(1, "Hello  world\n")], "doc_id long, text string"), pieces.default_model())
    assert pieces.decode_pieces(encoded, pieces.default_model()).first()["decoded"] == "Hello  world\n"


@pytest.mark.parametrize("clustered", [True, False])
def test_cover_tree_pairs(clustered):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    if clustered:
        x = np.repeat(x[:30], 10, axis=0) + rng.normal(scale=0.08, size=(300, 16))
    y = np.concatenate([x[:100] * 3, rng.normal(size=(50, 16))])
    for a, b in ((x, x), (x, y)):
        i, j = cover_tree.linked_pairs(a, b, 0.98)
        c = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None, :]
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, np.argwhere(c >= 0.98).tolist()))
    tree = cover_tree.CoverTree(x / np.linalg.norm(x, axis=1)[:, None], 0.05)
    for (nodes, children, _), (below, _, _) in zip(tree.levels, tree.levels[1:], strict=False):
        assert set(nodes) <= set(below) and sorted(np.concatenate(children)) == list(range(len(below)))


def test_shards_and_cells_give_what_one_shard_gives(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet")
    one, *others = (sorted(cover_tree.near_vectors(rows, **how).collect()) for how in ({}, {"shard_rows": 7}, {"cell_rows": 4}, {"cell_rows": 4, "shard_rows": 3}, {"cell_rows": 3, "most_pivots": 9}))
    assert all(one == x for x in others)


@pytest.mark.parametrize("seed", range(4))
def test_linked_vectors_meet_in_a_cell(seed):
    rng = np.random.default_rng(seed)
    x = np.repeat(rng.normal(size=(60, 8)), 12, axis=0) + rng.normal(scale=0.1, size=(720, 8))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    home, row, cell = cover_tree.cells_of(x, unit[rng.choice(720, 25, replace=False)], 0.98)
    visits = set(zip(row.tolist(), cell.tolist(), strict=True))
    i, j = np.nonzero(unit @ unit.T >= 0.98)
    assert all(home[a] == home[b] or ((a, home[b]) if home[a] < home[b] else (b, home[a])) in visits for a, b in zip(i.tolist(), j.tolist(), strict=True))
    assert len(visits) < 720 * 24 / 2


@pytest.mark.parametrize("size", [1e-308, 1e-200, 1.0, 1e200, 1e307])
def test_extreme_vectors_link(size):
    x = np.array([[1.0, 0, 0.5], [size, 0, 0.5 * size], [2.0, 0, 1.0], [0, size, 0]])
    i, j = cover_tree.linked_pairs(x, x, 0.98)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted([(a, b) for a in range(3) for b in range(3)] + [(3, 3)])
    n, _, label = cover_tree.link_counts(x, x, 0.98, np.ones(4), np.ones(4))
    assert n.tolist() == [3, 3, 3, 1] and label.tolist() == [0, 0, 0, 3]


def test_link_counts_keep_components():
    rng = np.random.default_rng(9)
    for _ in range(30):
        x = np.repeat(rng.normal(size=(6, 4)), 15, axis=0) + rng.normal(scale=0.12, size=(90, 4))
        y, copies = x[:40] * 2, rng.integers(1, 5, 90).astype(float)
        for b, cb in ((x, copies), (y, copies[:40])):
            n, m, label = cover_tree.link_counts(x, b, 0.98, copies, cb)
            linked = (x @ b.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None, :] >= 0.98
            at = (lambda k: k) if b is x else (lambda k: k + 90)
            assert np.allclose(n, linked @ cb) and np.allclose(m, copies @ linked)
            assert dict(enumerate(label.tolist())) == union([(int(p), at(int(q))) for p, q in np.argwhere(linked)], range(len(label)))


def test_pairs_beyond_additive_weights():
    rng = np.random.default_rng(0)
    bits = 12
    terms, y = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        terms.append(np.unique(np.concatenate([[1] if a else [2], [3] if b else [4], rng.integers(100, 140, 5)])).astype(np.int32))
        y.append(int(a and b) if rng.random() < 0.98 else int(rng.random() < 0.5))
    y = np.array(y)
    model = toxicity.fit_fm(terms, y, bits=bits, least_z=0)
    dense = [model.number[t] for t in terms]
    score = model.logits(np.concatenate(dense), np.cumsum([0, *map(len, dense)]))
    assert ((score > 0) == (y > 0)).mean() > 0.95
    xor = np.array([int((1 in t) != (3 in t)) for t in terms])
    model = toxicity.fit_fm(terms, xor, bits=bits, least_z=0, toxic_weight=1)
    score = model.logits(np.concatenate(dense), np.cumsum([0, *map(len, dense)]))
    assert ((score > 0) == (xor > 0)).mean() > 0.95  # no additive weights can do this


@pytest.mark.parametrize(("noise", "words"), [(5, 40), (200, 3000)])
def test_pairs_are_learned_with_the_defaults(noise, words):
    rng = np.random.default_rng(noise)

    def rows(n):
        terms, y = [], []
        for _ in range(n):
            a, b = rng.random(2) < 0.5
            terms.append(np.unique(np.concatenate([[1 if a else 2, 3 if b else 4], rng.integers(100, 100 + words, noise)])).astype(np.int32))
            y.append(int(a != b))  # neither term says anything alone
        return terms, np.array(y)

    model, (terms, y) = toxicity.fit_fm(*rows(1500), bits=13), rows(500)
    dense = [t[t > 0] for t in (model.number[x] for x in terms)]
    assert ((model.logits(np.concatenate(dense), np.cumsum([0, *map(len, dense)])) > 0) == (y > 0)).mean() > 0.95


def test_sampled_rows_keep_all_terms(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(4000 if i % 2 else 10))) for i in range(40)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    how = {"id_col": "doc_id", "text_col": "text", "label_col": "toxic", "learn": F.lit(True), "bits": 30}
    found, _, y = labelled_terms(docs, labels, **how)
    assert sorted({len(t) for t in found}) == [10, 4000] and len(y) == 40
    found, _, y = labelled_terms(docs, labels, sample_terms=20_000, **how)
    assert {len(t) for t in found} <= {10, 4000} and sum(map(len, found)) <= 20_000 and 4 <= len(y) < 40


@pytest.mark.parametrize("counted", [True, False])
def test_the_sample_is_fetched_in_pieces(spark, monkeypatch, counted):
    docs = spark.createDataFrame([(i, " ".join(f"w{k % (i + 1)}" for k in range(400))) for i in range(90)] + [(90, None), (91, ""), (5, "again")], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    how = {"id_col": "doc_id", "text_col": "text", "label_col": "toxic", "learn": F.lit(True), "counted": counted}
    whole, fetched, fetch = labelled_terms(docs, labels, **how), [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda df: fetched.append(fetch(df)) or fetched[-1])
    parts = labelled_terms(docs, labels, fetch_terms=500, **how)
    pieces = [t for t in fetched if "terms" in t.column_names]
    assert len(pieces) > 5 and all(sum(t["n"].to_pylist()) <= 500 for t in pieces) and sum(t.num_rows for t in pieces) == 93
    assert parts[2].tolist() == whole[2].tolist()
    for a, b in zip(parts[:2], whole[:2], strict=True):
        assert [x.tolist() for x in a] == [x.tolist() for x in b]
    keys = [(t.tobytes(), y) for t, y in zip(parts[0], parts[2].tolist(), strict=True)]
    assert keys == sorted(keys)
    none = labelled_terms(docs.limit(0), labels, **how)
    assert [len(x) for x in none] == [0, 0, 0]


def test_learning_holds_little_beside_the_sample():
    rng = np.random.default_rng(0)
    terms = [np.unique((rng.random(500) ** 4 * (1 << 21)).astype(np.int32)) for _ in range(3000)]
    y = (rng.random(3000) < 0.1).astype(np.int64)
    tracemalloc.start()
    try:
        toxicity.fit_fm(terms, y, epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6, peak


def test_toxicity_held_out(spark):
    sf = DATA.replace("0.001", "0.1")
    found = registry.queries()["op2_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.95 and n[1, 1] / (n[1, 1] + n[1, 0]) >= 0.9


def test_ordinal_grades():
    rng = np.random.default_rng(0)
    terms, counts, y = [], [], []
    for _ in range(1200):
        g = int(rng.integers(0, 4))
        good = rng.random(12) < g / 3
        t, c = np.unique(np.where(good, rng.integers(0, 20, 12), rng.integers(50, 70, 12)), return_counts=True)
        terms.append(t.astype(np.int32))
        counts.append(c)
        y.append(g)
    y = np.array(y)
    m = quality_classifier.fit_ordinal(terms, counts, y, bits=10)
    assert (np.diff(m.theta) > 0).all() and m.grades == [0, 1, 2, 3]
    rows = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    level = m.level(rows, np.concatenate(terms), np.concatenate(counts), len(terms))
    assert np.corrcoef(level, y)[0, 1] > 0.85


def test_quality_held_out(spark):
    sf = DATA.replace("0.001", "0.1")
    found = registry.queries()["op6_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert found.select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0] > 0.97


def test_language_held_out_and_mixtures(spark):
    sf = DATA.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = registry.queries()["op7_language"](spark, sf).join(docs, "doc_id").where("held_out")
    assert found.select(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.97
    some = {r["lang"]: r["text"] for r in docs.where("length(text) BETWEEN 800 AND 1500").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    mixed = spark.createDataFrame([(1, some["en"] + " " + some["de"]), (2, some["fr"])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.identify_languages(mixed, language.learn_languages(docs, fold("doc_id", 4) != 2)).collect()}
    assert set(got[1]["lang_set"].split(",")) == {"en", "de"} and 0.3 < got[1]["score"] < 0.75 and got[2]["lang_set"] == "fr"


def test_language_sets_of_any_size():
    for k in (2, 4, 6):
        scores = np.full((90 * k, 6), -40.0, np.float32)
        scores[np.arange(90 * k), np.arange(90 * k) % k] = -10
        share = language.choose(scores, np.array([0, 90 * k]))[0]
        assert (share[:k] > 0.9 / k).all() and (share[k:] == 0).all()


def test_a_small_share_stays_in_the_set(spark):
    """Languages that the penalised likelihood chooses are returned however small their share; one that it doesn't choose is not."""
    rng = random.Random(9)
    said = {lang: ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(400)] for lang, letters in (("aa", "abcdefg"), ("bb", "mnopqrs"), ("cc", "tuvwxyz"))}
    text = lambda **n: " ".join(w for lang, k in n.items() for w in rng.choices(said[lang], k=k))
    model = language.learn_languages(spark.createDataFrame([(lang, text(**{lang: 3000})) for lang in said], "lang string, text string"))
    docs = spark.createDataFrame([(1, text(aa=19_850, bb=150)), (2, text(aa=20_000)), (3, text(aa=500, bb=300, cc=200))], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_set"] for r in language.identify_languages(docs, model).collect()}
    assert got == {1: "aa,bb", 2: "aa", 3: "aa,bb,cc"}


def test_word_hashes():
    import pyarrow as pa

    texts = ["Ab  c\tD", None, "", " x ", "é\nÉ", "tail"]
    raw, at = wordhash.buffers(pa.array(texts).slice(0, 6))
    h, first = wordhash.word_hashes(raw, at)
    words = [(t or "").split() for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in words]
    flat = ["".join(c.lower() if c.isascii() else c for c in w) for t in words for w in t]
    assert len(set(h.tolist())) == len(set(flat)) and all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))
