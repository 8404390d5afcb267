"""Ordered lines: the same bytes at any number of ranges, collation, places."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from corvane.sources import ordered


def records(spark, n=500):
    rng = random.Random(3)
    ids = [f"fa:{rng.choice(['a', 'B', 'b-', 'b_', 'b:', 'é', 'Z', '1', '😀'])}{rng.randrange(60)}" for _ in range(n)]
    return spark.createDataFrame([(i, rng.randrange(3), "é\n" * (k % 4) or None) for k, i in enumerate(ids)] + [(None, 1, "x"), ("fa:z", None, None)] * 2, "id string, k int, text string")


def plain(rows):
    return [json.dumps({k: v for k, v in r.asDict().items() if v is not None}, ensure_ascii=False, separators=(",", ":")) for r in rows]


@pytest.mark.parametrize("collated", [False, True])
def test_equal_bytes_at_any_number_of_ranges(spark, tmp_path, collated):
    given = records(spark)
    files = []
    for n in (1, 8, 3):
        assert ordered.write_file(given.repartition(n + 1), tmp_path / f"{n}.jsonl", "id", "k", collated=collated, ranges=n) == 504
        files.append((tmp_path / f"{n}.jsonl").read_bytes())
    assert files[0] == files[1] == files[2]
    lines = files[0].decode().splitlines()
    if not collated:
        want = sorted(given.collect(), key=lambda r: (r["id"] is not None, (r["id"] or "").encode(), r["k"] is not None, r["k"] or 0))
        assert sorted(lines) == sorted(plain(want)) and [json.loads(x).get("id") for x in lines] == [r["id"] for r in want]
    else:
        first = [json.loads(x).get("id") for x in lines]
        ends = [[k for k, x in enumerate(first) if x and x.startswith(p)] for p in ("fa:1", "fa:a", "fa:b_", "fa:b-", "fa:b:", "fa:B", "fa:é", "fa:Z")]
        assert first[:2] == [None, None] and all(max(a) < min(b) for a, b in zip(ends, ends[1:], strict=False))
    listed = ordered.write_parts(given, f"file://{tmp_path}/parts", "id", "k", collated=collated, ranges=8).collect()
    parts = [p.read_bytes() for p in sorted((tmp_path / "parts").rglob("part=*/part-*"))]
    assert b"".join(parts) == files[0] and [len(p) for p in parts] == [r["bytes"] for r in listed]
    assert [r["start"] for r in listed] == [sum(len(p) for p in parts[:k]) for k in range(len(parts))]


def test_edges_of_files(spark, tmp_path):
    none = records(spark).limit(0)
    assert ordered.write_file(none, tmp_path / "none.jsonl", "id") == 0 and (tmp_path / "none.jsonl").read_bytes() == b""
    with pytest.raises(FileExistsError):
        ordered.write_file(none, tmp_path / "none.jsonl", "id")
    big = spark.range(20_000).select(F.col("id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("t"))
    assert ordered.write_file(big, tmp_path / "big.jsonl", "id") == 20_000
    rows = [json.loads(x) for x in (tmp_path / "big.jsonl").read_text().splitlines()]
    assert [r["id"] for r in rows] == list(range(20_000)) and all(len(r["t"]) == r["id"] % 50 for r in rows)
    assert not list(tmp_path.glob(".*"))
