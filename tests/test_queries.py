"""Every query outside the llm subpackage against its SQL, on the small tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

from corvane.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    rows = Counter(tuple(plain(r[c]) for c in cols) for r in got.collect())
    answer = duck.execute(SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == cols
    want = Counter(tuple(plain(dict(zip(names, r, strict=True))[c]) for c in cols) for r in answer.fetchall())
    assert rows == want


def test_book_sections(spark):
    rows = QUERIES["book_sections"](spark, DATA).collect()
    assert rows and all(r["start"] < r["end"] and r["characters"] >= 350 for r in rows)


def test_book_sections_of_all_documents(spark, tmp_path):
    lengths = [0, 5, 349, 350, 351, 399, 4001, 20_000]
    rows = [(i, ["en", "fi", None][i % 3], " ".join([f"w{i}"] * 20_000)[: lengths[i % 8]]) for i in range(130)]
    rows += [(1000, "en", None), (1001, "en", "ab\n\ncd " * 90), (1002, "en", "x " * 200 + "*** END OF it " + "y " * 200), (1003, "en", "z" * 500), (5000, "fi", "q" * 500)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    books: dict[str, list[tuple[str, str]]] = {}
    for i, lang, t in rows:
        books.setdefault(f"{lang or 'und'}-{i // 40}", []).append((f"STORY NUMBER {i}", (t or "").replace("\n", " ")))
    want = set()
    for book, entries in books.items():
        entries.sort()
        at = len("CONTENTS\n" + "\n".join(t for t, _ in entries) + "\nTHE BOOK BEGINS\n\n")
        for n, (title, t) in enumerate(entries, 1):
            end = at + len(title) + 2 + len(t) + (2 if n < len(entries) else 1)
            if len(t.strip()) >= 350:
                want.add((book, n, title, len(t.strip()), at, end))
            at = end
    got = QUERIES["book_sections"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
