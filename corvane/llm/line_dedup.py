"""Removal of repeated runs of lines by winnowing.

A passage is a run of successive lines (those with a word) that is `run` lines long or holds more than `words` words. A
fingerprint is the hash of a line. The shortest passages from each line on and up to each line are the windows; of each,
the smallest fingerprint is selected (the first among equals). Two equal passages hold an equal window, so they
select the same line of it: a guaranteed meeting point. Only selected positions leave the first stage, each with the
windows that selected it.

Positions are joined by fingerprint, and those met at two places or more are extended both ways, over the lines in front of
and behind them, to the ends of their windows. Of equal stretches all but the first in order of document and place are taken
out; stretches that touch grow together, so a later run goes whole, however long it is: each line of an equal
passage lies in a window inside it.

Occurrences are counted and the first one found by partial aggregation. Fingerprints and stretches with more than their
share of the rows are met through a broadcast of bounded size, all others by a shuffle (common.join_counted).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, join_counted, table
from .wordhash import BLANK, buffers, mix, runs, span_hashes, word_spans

RUN, WORDS = 3, 50
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_LAST = (1 << 63) - 1


def _lines(part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and words of the lines that hold a word, and each text's first such line."""
    starts, ends, first = word_spans(part, offsets, _NEWLINE)
    words, _, _ = word_spans(part, offsets)
    n_words = np.searchsorted(words, ends) - np.searchsorted(words, starts)
    full = n_words > 0
    return span_hashes(part, starts, ends, lower=False)[full], n_words[full], np.concatenate([[0], np.cumsum(full)])[first]


def winnow(lines: np.ndarray, n_words: np.ndarray, first: np.ndarray, run: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each window, sorted by the position it selects: text, place of the selected line, its fingerprint, lines in front of
    it in the window times run plus lines behind it, hash of the window."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    through = np.concatenate([[0], np.cumsum(n_words)])
    n = len(lines)
    passage = np.zeros(n + 1, bool)  # whether the run of the last length from each line on is one
    found = [[np.zeros(0, t)] for t in (np.int64, np.uint64, np.int64, np.uint64)]
    h = np.zeros(n, np.uint64)
    for length in range(1, run + 1):
        m = max(0, n - length + 1)
        h = mix(h[:m] * np.uint64(0x9E3779B97F4A7C15) + lines[length - 1 :])
        whole = text[:m] == text[length - 1 :]
        now = whole & ((length == run) | (through[length:] - through[: m] > words)) if m else np.zeros(0, bool)
        at = np.flatnonzero(now & ~(passage[:m] & passage[1 : m + 1]))
        passage = np.append(now, False)
        if len(at):
            views = np.lib.stride_tricks.sliding_window_view(lines, length)[at]
            pick = views.argmin(1)
            found[0].append(at + pick)
            found[1].append(views[np.arange(len(at)), pick])
            found[2].append(pick * run + length - 1 - pick)
            found[3].append(mix(h[at] + np.uint64(length)))
    at, mark, reach, window = (np.concatenate(x) for x in found)
    order = np.lexsort((reach, at))
    at = at[order]
    return text[at], at - first[text[at]], mark[order], reach[order], window[order]


def drop_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, words: int = WORDS) -> DataFrame:
    """All columns of docs, with text_col cleaned, and n_lines, n_removed, n_runs.

    Lines are split at newlines; only lines with a word count, others stay. A stretch of such lines that has `run` lines or
    more than `words` words and equals one earlier, by id, then text hash, then place, is removed; overlapping stretches go as
    one run, also inside one text. A null text stays null and has no lines; a text without such a stretch is unchanged.
    Ids are ordered as whole numbers; null ids and others that are none come last, in the order of a hash of id and text. Rows equal in id and text count as one document and
    get the same result. An empty table gives an empty result. Names of docs that clash with the three counts are
    replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    number = F.col(id_col).cast("string").try_cast("long") if docs.schema[id_col].dataType.simpleString() != "bigint" else F.col(id_col)
    key = (F.coalesce(number, F.lit(_LAST)), F.xxhash64(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit(""))))
    texts = docs.select(key[0].alias("id"), F.col(text_col).alias("text"), key[1].alias("th"))

    def selected(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = pa.struct([("reach", pa.int32()), ("h", pa.int64())])
        for batch in it:
            ids, th = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            raw, at = buffers(batch.column(1))
            for a, _, part, offsets in runs(raw, at):
                text, place, mark, reach, h = winnow(*_lines(part, offsets), run, words)
                begins = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(place, prepend=-1) != 0))
                stretches = pa.StructArray.from_arrays([pa.array(reach.astype(np.int32)), pa.array(h.view(np.int64))], fields=list(stretch))
                lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(h)).astype(np.int32)), stretches)
                yield pa.RecordBatch.from_arrays([pa.array(mark[begins].view(np.int64)), pa.array(ids[a + text[begins]]), pa.array(th[a + text[begins]]), pa.array(place[begins]), lists], names=["mark", "id", "th", "place", "stretches"])

    positions = scratch.write(texts.mapInArrow(selected, "mark long, id long, th long, place long, stretches array<struct<reach: int, h: long>>"), "positions")
    spot = F.struct("id", "th", "place")
    met = positions.groupBy("mark").agg(F.min(spot).alias("one"), F.max(spot).alias("two"), F.count("*").alias("n")).where("one <> two").select("mark", "n")
    meeting = join_counted(positions, scratch.write(met, "met"), ["mark"], "n")
    extended = meeting.select("mark", "id", "th", "place", F.explode("stretches").alias("s")).select("mark", "id", "th", (F.col("place") - F.floor(F.col("s.reach") / run)).alias("start"), (F.floor(F.col("s.reach") / run) + F.col("s.reach") % run + 1).alias("size"), "s.h")
    extended = scratch.write(extended, "extended")
    spot = F.struct("id", "th", "start")
    firsts = extended.groupBy("mark", "h").agg(F.min(spot).alias("first"), F.max(spot).alias("last"), F.count("*").alias("n")).where("first <> last").select("mark", "h", "first", "n")
    later = join_counted(extended, scratch.write(firsts, "firsts"), ["mark", "h"], "n").where(spot > F.col("first"))
    removed = scratch.write(later.groupBy("id", "th").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("places")), "removed")

    names = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs")]
    inner = [docs.schema[c] for c in names]
    t = names.index(text_col)
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], key[0].alias("key_id"), key[1].alias("key_th"))

    def clean(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts, n_lines, n_removed, n_runs = [], [], [], []
            for text, places in zip(batch.column(t), batch.column(batch.num_columns - 1), strict=True):
                text = text.as_py()
                lines = text.split("\n") if text is not None else []
                inked = [k for k, line in enumerate(lines) if line.strip(" \t\n\x0b\x0c\r")]
                gone = sorted({p["start"] + k for p in places.as_py() or () for k in range(p["size"])})
                if gone:
                    out = {inked[g] for g in gone}
                    text = "\n".join([line for k, line in enumerate(lines) if k not in out])
                texts.append(text)
                n_lines.append(len(inked))
                n_removed.append(len(gone))
                n_runs.append(sum(1 for k, g in enumerate(gone) if not k or g != gone[k - 1] + 1))
            columns = [pa.array(texts, pa.string()) if k == t else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_runs, pa.int64())], names=[*(f"c{k}" for k in range(len(names))), "n_lines", "n_removed", "n_runs"])

    kinds = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(inner))
    # The removals grow with the input, so the join is a sort-merge at every size and never a broadcast of what happens to be small.
    joined = plain.join(removed.select(F.col("id").alias("key_id"), F.col("th").alias("key_th"), "places").hint("merge"), ["key_id", "key_th"], "left")
    joined = joined.select(*[f"c{k}" for k in range(len(names))], "places")
    out = joined.mapInArrow(clean, f"{kinds}, n_lines long, n_removed long, n_runs long")
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)], "n_lines", "n_removed", "n_runs")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id, text FROM documents),
split AS (SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM (SELECT r, string_split(text, chr(10)) AS ls FROM d WHERE text IS NOT NULL)),
inked AS (SELECT r, i, line, row_number() OVER (PARTITION BY r ORDER BY i) AS p, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
win AS (SELECT r, p, n1, n2, n3, w, unnest([1, 2, 3]) AS size FROM (
  SELECT r, p, [line, lead(line, 1) OVER o, lead(line, 2) OVER o] AS w, n AS n1, lead(n, 1) OVER o AS n2, lead(n, 2) OVER o AS n3 FROM inked WINDOW o AS (PARTITION BY r ORDER BY p))),
passage AS (SELECT r, p, size, w[1:size] AS w FROM win WHERE CASE size WHEN 1 THEN n1 > 50 WHEN 2 THEN n1 + n2 > 50 ELSE n3 IS NOT NULL END),
later AS (SELECT r, p, size FROM (SELECT r, p, size, row_number() OVER (PARTITION BY w ORDER BY r, p) AS k FROM passage) WHERE k > 1),
gone AS (SELECT DISTINCT r, p + k AS p FROM (SELECT r, p, unnest(range(size)) AS k FROM later)),
runs AS (SELECT r, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before <> p - 1) AS n_runs FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM gone) GROUP BY r),
kept AS (SELECT s.r, string_agg(s.line, chr(10) ORDER BY s.i) AS text FROM split s LEFT JOIN inked n ON s.r = n.r AND s.i = n.i LEFT JOIN gone g ON n.r = g.r AND n.p = g.p WHERE g.p IS NULL GROUP BY s.r),
n AS (SELECT r, count(*) AS n_lines FROM inked GROUP BY r)
SELECT doc_id, CAST(coalesce(n.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN runs USING (r) LEFT JOIN kept USING (r)
"""
