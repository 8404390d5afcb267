"""Importance resampling against plain Python, and its edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corvane.llm import resample
from corvane.llm.wordhash import buffers

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, target, k, buckets, percent, least, seed):
    def found(text):
        w = words_of(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, k + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in docs for b in found(x)), Counter(b for x in target for b in found(x))
    own, theirs = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * own / ((s[b] + 1) * theirs)))
    rows = []
    for i, x in docs:
        f = found(x)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words_of(x))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = place + 1
    return Counter(tuple(r[:5]) for r in rows)


@pytest.mark.parametrize(("k", "buckets", "percent", "least", "a_range"), [(1, 10_000, 10, 20, 4096), (2, 50, 40, 0, 7), (3, 997, 100, 3, 5)])
def test_resample(spark, k, buckets, percent, least, a_range):
    rng = random.Random(k)
    vocabulary = [f"wort{i}" for i in range(40)] + ["Ärger", "ÉTÉ", "你好", "x" * 700, "x" * 255, "y" * 257, "it's"]
    docs = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", ".", "\n", ","]) for _ in range(rng.randrange(60)))) for i in range(300)]
    docs += [(None, docs[4][1]), (7, docs[7][1]), (7, docs[7][1]), (1000, None), (1001, ""), (1002, " .,; \t"), (1003, "w " * 30_000)]
    target = [" ".join(rng.choice(vocabulary[:9]) for _ in range(50)) for _ in range(20)] + [None, ""]
    given = spark.createDataFrame([(i, x, 1, 2, 3) for i, x in docs], "doc_id long, text string, at int, score int, part int").repartition(5)
    wanted = spark.createDataFrame([(x, 9) for x in target], "text string, n int")
    got = resample.resample(given, wanted, words=k, buckets=buckets, percent=percent, least_words=least, seed=5, rows_a_range=a_range)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == plain(docs, target, k, buckets, percent, least, 5)


def test_without_rows(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a few words")], "doc_id long, text string")
    assert resample.resample(none, some).collect() == []
    assert resample.resample(none, none).collect() == []
    assert [tuple(r) for r in resample.resample(some, none).collect()] == list(plain([(1, "a few words")], [], 1, 10_000, 10, 20, 2024))
    with pytest.raises(TypeError, match="whole numbers"):
        resample.resample(spark.createDataFrame([("a", "b")], "doc_id string, text string"), some)


def test_crc_of_spans():
    rng = random.Random(1)
    data = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 255, 256, 257, 3000, 0, 7)]
    raw, at = buffers(pa.array([d.hex() for d in data]))
    got = resample.crc_of_spans(raw, at[:-1], at[1:], np.array([zlib.crc32(b"ab")] * len(data), np.uint32))
    assert got.tolist() == [zlib.crc32(b"ab" + d.hex().encode()) for d in data]
