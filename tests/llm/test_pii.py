"""Personal data: strict spans against plain Python, loose spans on planted forms, the model against plain loops."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import pii

STRICT = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}
SCHEMA = "doc_id long, text string, start int, kind string, spans long"


def luhn(d):
    return sum((2 * x - 9 if x > 4 else 2 * x) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def holds(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in s.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def strict(text):
    return [(k, m.start(), m.end()) for k, (kind, p) in enumerate(STRICT.items()) for m in p.finditer(text or "") if holds(kind, m[0])]


def card(rng, n=16, front="4"):
    d = front + "".join(rng.choice("0123456789") for _ in range(n - 1 - len(front)))
    return next(d + c for c in "0123456789" if luhn(d + c))


def run(spark, texts, **how):
    docs = spark.createDataFrame([(i, t, 1, "k", 2) for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in pii.find_private(docs, **how).collect()}


def test_strict_spans(spark):
    rng = random.Random(4)
    parts = ["a", "Z9", "@", ".", "..", "_", "%", "-", " ", "é", "😀", "\n", "+", "(", ")", "0", "12", "255", "256", "007", "1.2.3.4", "x@y.z", card(rng), card(rng, 19, "6"), card(rng)[:4] + " " + "12-34", "+1 (213) 555-0101", "\x01", "ß@"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(600)]
    texts += [None, "", " \n", "a@b.c_d@e.f a@b@c.d", "x" * 8000, "9" * 8000, "1." * 8000, "+1" + "(" * 8000, "é 😀 " * 20_000 + "jo@mail.example.com", " ".join(f"u{i}@h{i}.org" for i in range(3000)), " ".join(card(rng) for _ in range(2000))]
    got = run(spark, texts)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert [(c["kind"], c["start"], c["end"]) for c in got[i]["strict"]] == strict(t), t[:200]
        assert set(map(tuple, got[i]["strict"])) <= set(map(tuple, got[i]["spans"]))


def test_long_runs_take_linear_time(spark):
    texts = ["x" * 10**6, "x" * 10**6 + "@", "9" * 10**6, "1." * 10**5, "+1" + "(" * 10**6, "a " * 500_000 + "at ", ":" * 10**6, "- " * 500_000]
    assert all(not r["spans"] or i == 3 for i, r in run(spark, texts).items())


PLANTED = {
    "email": ["jane.doe (at) example (dot) com", "info[at]firma.de", "jörg.müller@bücher.de", "Maria {at} correo {dot} es"],
    "ip": ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1:2:3:4", "84[.]17[.]22[.]195"],
    "phone": ["(213) 555-0142", "0049 30 12345678", "030/12345678", "213-555-0142"],
}
CLEAN = ["Look at home.The door was open, he said.", "They met at 12:30:45 and left at 13:05:10.", "In 2024-01-31 and 12.05.1999 sums of 200 300 400 came up.", "Version 1.2.3.4 was no address, see pages 100-200.", "Order 4556737586899850 of 2021", "The value 3.14159265358979 is pi.", "ISBN 978-3-16-148410-0.", "They arrived at night.But late."]


def test_loose_spans(spark):
    rng = random.Random(8)
    texts, wanted = [], {}
    for kind, forms in PLANTED.items():
        for form in forms:
            wanted[len(texts)] = (pii.KINDS.index(kind), form)
            texts.append(f"Das ist Text vorher. Contact {form}, then more text.")
    amex = card(rng, 15, "37")
    wanted[len(texts)] = (2, f"{amex[:4]} {amex[4:10]} {amex[10:]}")
    texts.append(f"They took my card {wanted[len(texts)][1]} away.")
    two = card(rng), card(rng)
    texts.append(f"Both {two[0]} {two[1]} were used.")
    texts += CLEAN
    texts += [f"Write to {rng.choice('abc')}{i}@mail.example.com or call +1 (213) 555-{i:04}, host 84.17.{i % 250}.9, card {card(rng)}." for i in range(150)]
    got = run(spark, texts)
    for i, (kind, form) in wanted.items():
        start = texts[i].index(form)
        found = [(c["kind"], c["start"], c["end"]) for c in got[i]["spans"]]
        assert (kind, start, start + len(form)) in found, (texts[i], found)
    both = len(wanted)
    assert [texts[both][c["start"] : c["end"]] for c in got[both]["spans"] if c["kind"] == 2] == list(two) and not got[both]["strict"]
    for i, t in enumerate(CLEAN, both + 1):
        assert [tuple(c) for c in got[i]["spans"]] == [tuple(c) for c in got[i]["strict"]], t
        assert len(got[i]["spans"]) == ("1.2.3.4" in t), t


def test_model_against_plain_loops():
    rng = random.Random(2)
    truth = [rng.random() < 0.4 for _ in range(4000)]
    right = [0.95, 0.8, 0.7, 0.9, 0.6, 0.55, 0.85]
    votes = np.array([[(1 if rng.random() < r else -1) * (1 if y else -1) * (rng.random() < 0.8) for r in right] for y in truth])
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    chance, share, belief = pii._expectation_maximisation(patterns, n.astype(float))
    assert abs(share - 0.4) < 0.03
    for j, r in enumerate(right):
        assert abs(chance[j, 1, 2] / (chance[j, 1, 0] + chance[j, 1, 2]) - r) < 0.06
    for p, b in zip(patterns.tolist(), belief.tolist(), strict=True):
        yes, no = math.log(share), math.log(1 - share)
        for j, v in enumerate(p):
            yes, no = yes + math.log(chance[j, 1, v + 1]), no + math.log(chance[j, 0, v + 1])
        assert abs(b - 1 / (1 + math.exp(no - yes))) < 1e-6
    bits = np.column_stack([patterns == 1, patterns == -1]).astype(float)
    first = np.zeros(15)
    w = pii._logistic(bits, n.astype(float), belief, first)
    x = np.column_stack([np.ones(len(bits)), bits])
    loss = lambda w: float((n * (np.logaddexp(0, x @ w) - belief * (x @ w))).sum() + ((w - first) ** 2).sum() / 2)
    for j in range(15):
        for d in (-1e-3, 1e-3):
            assert loss(w + d * np.eye(15)[j]) >= loss(w)


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pii.find_private(none).collect() == []
    text = "Mail a@b.org twice"
    given = spark.createDataFrame([(None, text, 1, "k", 2), (1, text, 1, "k", 2), (1, text, 1, "k", 2), (2, None, 1, "k", 2)], SCHEMA)
    got = pii.find_private(given).select("doc_id", F.size("spans").alias("n")).collect()
    assert sorted((r["doc_id"] or 0, r["n"]) for r in got) == [(0, 1), (1, 1), (1, 1), (2, 0)]
    with pytest.raises(TypeError, match="whole numbers"):
        pii.find_private(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
