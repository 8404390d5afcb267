"""Queries that SQL can express, against that SQL."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

from corvane.llm import registry

DATA = "/root/testdata/sf0.001"


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    got = registry.queries()[name](spark, DATA)
    cols = sorted(got.columns)
    rows = Counter(tuple(plain(r[c]) for c in cols) for r in got.collect())
    answer = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == cols
    assert rows == Counter(tuple(plain(dict(zip(names, r, strict=True))[c]) for c in cols) for r in answer.fetchall())
