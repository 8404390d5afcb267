"""Conversation repair against all edit scripts, a plain rewriting of the contract, and its edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from corvane.llm import conversations
from corvane.llm.conversations import Chart

GOOD = re.compile(r"(s?(ua)+)?\Z")


def all_scripts(turns):
    """The least (cost, audit) of all scripts with at most two insertions in a gap. turns: (initial, must go, truncated)."""
    best = None
    for inserted in itertools.product(["", "u", "a", "ua", "au"], repeat=len(turns) + 1):
        for edits in itertools.product("KDua", repeat=len(turns)):
            cost, audit, roles = 0, "", ""
            for k in range(len(turns) + 1):
                cost, audit, roles = cost + 3 * len(inserted[k]), audit + "I" * len(inserted[k]), roles + inserted[k]
                if k == len(turns):
                    break
                initial, must, cut = turns[k]
                if must and edits[k] != "D":
                    cost = None
                    break
                cost += 4 if edits[k] == "D" else 3 * cut + 3 * (edits[k] != "K")
                audit += edits[k] if edits[k] in "KD" else "R"
                roles += {"D": "", "K": initial}.get(edits[k], edits[k])
            if cost is not None and GOOD.match(roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def parsed(turns):
    chart = Chart()
    for initial, must, cut in turns:
        chart.delete() if must else chart.scan(initial, cut)
    return chart.repair()


def test_chart_against_all_scripts():
    rng = random.Random(5)
    for n in (0, 1, 2, 2, 3, 3, 3, 3):
        turns = [(rng.choice("ssuaax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]
        assert parsed(turns) == all_scripts(turns), turns


def dictionary(turns):
    """All columns whole, without settling anything."""
    close = lambda c: [c.update({b: min(c[b], (c[a][0] + 3, c[a][1] + "I")) if b in c else (c[a][0] + 3, c[a][1] + "I")}) for _ in range(3) for a, b in ("No", "So", "Co", "oC") if a in c]
    column = {"N": (0, "")}
    close(column)
    for initial, must, cut in turns:
        new = {q: (c + 4, a + "D") for q, (c, a) in column.items()}
        for a, b, role in (("N", "S", "s"), ("N", "o", "u"), ("S", "o", "u"), ("C", "o", "u"), ("o", "C", "a")):
            if must or a not in column or (role == "s" != initial):
                continue
            found = (column[a][0] + 3 * cut + 3 * (role != initial), column[a][1] + ("K" if role == initial else "R"))
            new[b] = min(new.get(b, found), found)
        close(new)
        column = new
    return min(column[q] for q in "NC" if q in column)


@pytest.mark.parametrize("span", [1, 3, 256])
def test_settled_audits(monkeypatch, span):
    monkeypatch.setattr(conversations, "COLUMN_SPAN", span)
    rng = random.Random(span)
    for kinds in ("ua", "sua", "aaau", "s", "xu", "ssssua", "u", "a"):
        for must in (0, 0.1, 0.9, 1):
            turns = [(rng.choice(kinds), rng.random() < must, rng.random() < 0.3) for _ in range(rng.randrange(70))]
            turns += [("s", False, False), ("u", False, False), ("a", False, False)] * rng.randrange(2)
            assert parsed(turns) == dictionary(turns), turns


def test_a_long_conversation_takes_linear_time():
    chart = Chart()
    for k in range(60_000):
        chart.scan("uasx"[k % 4] if k % 7 else "a", k % 5 == 0)
    chart.delete(10**6)
    assert len(chart.repair()[1]) >= 10**6 + 60_000 and all(len(a) < 2 * 10**6 for _, a in chart.column.values())


def plain(rows):
    """rows of one conversation after damage: (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    known = sorted({r[0] for r in rows if r[0] is not None})
    counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))}
    seen, turns = set(), []
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        turns.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = dictionary(turns)
    out, at = [], iter(rows)
    for e in audit:
        role, text = ("", "") if e == "I" else next(at)[1:]
        if e != "D":
            k = len(out) - bool(out and out[0][0][:1] == "s")
            out.append((role if e == "K" else ("user", "assistant")[k % 2], "" if e == "I" else text))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (known[-1] - known[0] + 1 - len(known) if known else 0, *counts.values(), cost, audit, sha), out


def hurt(rows):
    for conv, turn, role, text in rows:
        some = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{some(conv)}:{some(turn)}".encode()) % 20
        role, text = "user" if k == 4 else some(role), {1: "", 2: re.sub("[.!?]", "", some(text))}.get(k, some(text))
        for _ in range({0: 0, 3: 2}.get(k, 1)):
            yield conv, turn, role, text


def test_against_plain_python(spark):
    rng = random.Random(11)
    texts = ["Yes.", "No!", "What?", "cut off", "", "  \n", None, "é 你好。", "é 你好.", "line\nline.", "x. ", "Yes."]
    rows = [(c, rng.choice([None, *range(-2, 12)]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]), rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randrange(10**6)}.") for c in [None, *range(60)] for _ in range(rng.randrange(1, 14))]
    rows += [(100, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.") for k in range(700)] + [(101, 5, "user", "again and again.")] * 400 + [(102, k, "user", "same") for k in range(300)]
    rows += [(103, 2**62, "user", "far."), (103, -(2**62), "user", "far away." + "long " * 200_000)]
    given = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, n int, kind string").repartition(6)
    got = conversations.Conversations(conversations.damaged(given), times="times").digests().collect()
    after = {c: [] for c, *_ in rows}
    for c, *row in hurt(rows):
        after[c].append(tuple(row))
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == {c: plain(x)[0] for c, x in after.items()}
    assert len(got) == len(after)
    turns = conversations.Conversations(conversations.damaged(given), times="times").turns().collect()
    by = {c: [] for c in after}
    for r in sorted(turns, key=lambda r: r["place"]):
        by[r["conv_id"]].append((r["role"], r["text"]))
    assert by == {c: plain(x)[1] for c, x in after.items()}


def test_without_rows_and_with_odd_ids(spark):
    none = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert conversations.repair_conversations(none).collect() == []
    assert conversations.repaired_turns(none).collect() == []
    with pytest.raises(TypeError, match="whole numbers"):
        conversations.repair_conversations(spark.createDataFrame([("a", 1, "user", "b")], "conv_id string, turn int, role string, text string"))
