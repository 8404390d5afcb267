"""Hashed terms of texts, and the bounded sample of labelled rows that the classifiers learn from."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .wordhash import PUNCT, buffers, mix, runs, span_hashes, word_spans

TERM_BITS = 18
#: The most labelled rows that a classifier learns from: those with the smallest hash of their id. A bound on the driver's memory.
SAMPLE_ROWS = 12_000
#: The most hashed terms that the sample holds in all; rows are taken whole, in order of the hash, until the next one would not fit. With SAMPLE_ROWS, it bounds what the driver holds.
SAMPLE_TERMS = 24_000_000
#: The driver fetches the sample in pieces of about so many terms, so that neither its JVM nor its Python holds a whole sample's results beside the sample.
FETCH_TERMS = 2_000_000

_SYMBOL = np.ones(256, bool)
_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = False


def again(term: np.ndarray, bits: int) -> np.ndarray:
    """The term that says that this one occurs twice or more."""
    return (mix(term.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - bits)).astype(np.int64)


def terms_of(texts: pa.Array, bits: int = TERM_BITS, symbols: bool = False, prefixes: Sequence[int] = (), repeated: bool = False, number: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of all texts, sorted by row and term; a row's term occurs once. Terms are runs of letters and
    digits in lower case, hashed to 2^bits; with symbols, runs of ASCII punctuation marks are terms too; with prefixes,
    so are the first so many bytes of longer words, which catch inflected and compound forms of a stem; with repeated,
    a term that a row holds twice or more gives one more term that says so (with count 1).
    number: a table from terms to dense numbers; terms with number 0 are left out early, and the numbers are returned."""
    raw, at = buffers(texts)
    wanted = None if number is None else number > 0
    if wanted is not None and repeated:
        wanted = wanted | wanted[again(np.arange(1 << bits), bits)]
    rows, terms, counts = [], [], []
    for first, last, part, offsets in runs(raw, at):
        own_rows, own = [], []

        def add(row: np.ndarray, h: np.ndarray) -> None:
            term = (h >> np.uint64(64 - bits)).astype(np.int64)
            if wanted is not None:
                row, term = row[wanted[term]], term[wanted[term]]
            own_rows.append(row)  # noqa: B023
            own.append(term)  # noqa: B023

        for between in (PUNCT, _SYMBOL)[: 1 + symbols]:
            starts, ends, words = word_spans(part, offsets, between)
            row = np.repeat(np.arange(last - first), np.diff(words))
            add(row, span_hashes(part, starts, ends))
            for k in prefixes if between is PUNCT else ():
                long = ends - starts > k
                add(row[long], mix(span_hashes(part, starts[long], starts[long] + k) + np.uint64(k)))
        key = (np.concatenate(own_rows) << bits) | np.concatenate(own)
        key, n = np.unique(key, return_counts=True)
        if repeated:
            twice = key[n > 1]
            key, n = np.concatenate([key, (twice >> bits << bits) | again(twice & ((1 << bits) - 1), bits)]), np.concatenate([n, np.ones(len(twice), n.dtype)])
            key, at_first = np.unique(key, return_index=True)
            n = n[at_first]
        row, term = (key >> bits) + first, key & ((1 << bits) - 1)
        if number is not None:
            term = number[term].astype(np.int64)
            row, term, n = row[term > 0], term[term > 0], n[term > 0]
        rows.append(row)
        terms.append(term)
        counts.append(n)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(terms), np.concatenate(counts)


def labelled_terms(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, learn: Column, sample_rows: int = SAMPLE_ROWS, sample_terms: int = SAMPLE_TERMS, fetch_terms: int = FETCH_TERMS, bits: int = TERM_BITS, symbols: bool = False, prefixes: Sequence[int] = (), repeated: bool = False, counted: bool = True) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Terms, counts and label of a bounded sample of labelled rows for which `learn` (an expression over doc_id) holds.

    The bound is on rows: at most sample_rows, and no more than hold sample_terms terms together. A row that is taken gives
    all its terms. Only chosen ids and labels are sent to the executors; the sample lies in the shared folder, the
    driver adds up its rows' numbers of terms and fetches those that fit, about fetch_terms at a time, into one array of
    their size. The rows that are returned are parts of it.
    """
    ids = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label is not null").where(learn)
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label")).select(F.xxhash64("doc_id").alias("place"), "doc_id", "label").orderBy("place", "doc_id").limit(sample_rows)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "doc_id")

    def batches(it):
        for batch in it:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                rows, terms, counts = terms_of(part.column(2), bits, symbols, prefixes, repeated)
                ends = np.searchsorted(rows, np.arange(part.num_rows + 1))
                spans = list(zip(ends[:-1], ends[1:], strict=True))
                yield pa.RecordBatch.from_pydict({"place": part.column(0), "label": part.column(1), "n": pa.array(np.diff(ends).astype(np.int64)), "terms": pa.array([terms[a:b].astype(np.int32).tobytes() for a, b in spans], pa.binary()), "counts": pa.array([counts[a:b].astype(np.int32).tobytes() if counted else b"" for a, b in spans], pa.binary())})

    sample = Scratch(docs.sparkSession, "labelled").write(chosen.select("place", "label", "text").mapInArrow(batches, "place long, label int, n long, terms binary, counts binary"), "sample")
    sizes = sample.groupBy("place").agg(F.sum("n").alias("n")).toArrow().sort_by("place")
    through = np.cumsum(sizes["n"].to_numpy())
    fit = int((through <= sample_terms).sum())
    places = sizes["place"].to_numpy()[:fit]
    total = int(through[fit - 1]) if fit else 0
    flat, flat_counts = np.zeros(total, np.int32), np.zeros(total if counted else 0, np.int32)
    filled, begin, lengths, found_labels = 0, 0, [], []
    while begin < fit:
        before = int(through[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(through[:fit], before + fetch_terms, "right")))
        piece = sample.where(F.col("place").between(int(places[begin]), int(places[end - 1]))).select("label", "n", "terms", "counts").toArrow()
        for batch in piece.to_batches():
            if not batch.num_rows:
                continue
            for column, held in ((2, flat), (3, flat_counts)):
                if len(held):
                    now = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in batch.column(column)])
                    held[filled : filled + len(now)] = now
            filled += int(batch.column(1).to_numpy().sum())
            lengths.append(batch.column(1).to_numpy().copy())
            found_labels.append(batch.column(0).to_numpy().copy())
        begin = end
        del piece
    ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths]))
    y = np.concatenate([np.zeros(0, np.int64), *found_labels]).astype(np.int64)
    # In the order of the terms' bytes, over views and not copies of them.
    as_bytes = lambda held: pa.Array.from_buffers(pa.large_binary(), len(y), [None, pa.py_buffer(ends * 4), pa.py_buffer(held)])
    keys = pa.table({"terms": as_bytes(flat), "label": pa.array(y), **({"counts": as_bytes(flat_counts)} if counted else {})})
    order = pc.sort_indices(keys, [(k, "ascending") for k in keys.column_names]).to_numpy()
    read = lambda held: [held[ends[i] : ends[i + 1]] for i in order]
    return read(flat), read(flat_counts) if counted else [flat_counts] * len(y), y[order]


def compact(terms: list[np.ndarray], bits: int, least_rows: int) -> tuple[np.ndarray, int]:
    """Dense numbers, from 1, of the terms that occur in at least least_rows rows; 0 for the others."""
    seen = np.bincount(np.concatenate(terms), minlength=1 << bits) if terms else np.zeros(1 << bits, np.int64)
    keep = np.flatnonzero(seen >= least_rows)
    number = np.zeros(1 << bits, np.int32)
    number[keep] = np.arange(1, len(keep) + 1)
    return number, len(keep)


def telling(terms: list[np.ndarray], labels: np.ndarray, bits: int, least_rows: int, least_z: float) -> np.ndarray:
    """Terms whose rows hold label 1 more or less often than all rows by at least least_z standard deviations."""
    n = max(len(terms), 1)
    rate = min(max(labels.sum() / n, 0.5 / n), 1 - 0.5 / n)
    seen, hit = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
    for t, y in zip(terms, labels, strict=True):
        seen[t] += 1
        hit[t] += int(y)
    often = np.flatnonzero(seen >= least_rows)
    seen, hit = seen[often], hit[often]
    z = (hit - seen * rate) / np.sqrt(np.maximum(seen, 1) * rate * (1 - rate))
    return often[np.abs(z) >= least_z]


def telling_in_pairs(terms: list[np.ndarray], labels: np.ndarray, score: np.ndarray, bits: int, least_rows: int, least_z: float, most_terms: int) -> np.ndarray:
    """Terms of pairs whose common rows hold label 1 more or less often than `score` says, by at least least_z standard
    deviations, however little either term tells alone.

    score: the probability of label 1 by the terms that tell alone. All pairs are looked at among the most_terms terms
    whose presence varies most over the rows, as products of blocks of a row-by-term matrix. Rows with equal terms and
    label count once, so that copies of a text prove nothing. The matrix is held as bits, and a few of its columns are numbers
    at a time.
    """
    once = sorted({(hashlib.blake2b(np.ascontiguousarray(t), digest_size=16).digest(), int(y)): i for i, (t, y) in enumerate(zip(terms, labels, strict=True))}.values())
    seen = np.zeros(1 << bits, np.int32)
    for i in once:
        seen[terms[i]] += 1
    often = np.flatnonzero(seen >= least_rows)
    spread = seen[often] * (1 - seen[often] / max(len(once), 1))
    keep = np.argsort(-spread, kind="stable")[:most_terms]
    keep = often[np.sort(keep[spread[keep] > 0])]
    if len(keep) < 2:
        return np.zeros(0, np.int64)
    number = np.full(1 << bits, -1, np.int32)
    number[keep] = np.arange(len(keep))
    x = np.zeros((len(once), -(-len(keep) // 8)), np.uint8)
    row = np.zeros(len(keep), bool)
    for r, i in enumerate(once):
        at = number[terms[i]]
        at = at[at >= 0]
        row[at] = True
        x[r] = np.packbits(row)
        row[at] = False
    p = score[once]
    left, spread_of = (labels[once] - p).astype(np.float32)[:, None], (p * (1 - p)).astype(np.float32)[:, None]
    told, block = np.zeros(len(keep), bool), 128
    columns = lambda a: np.unpackbits(x[:, a // 8 : (a + block) // 8], axis=1)[:, : len(keep) - a].astype(np.float32)
    for a in range(0, len(keep), block):
        one = columns(a)
        one_left, one_spread = one * left, one * spread_of
        for b in range(a, len(keep), block):
            two = one if b == a else columns(b)
            strong = np.abs(one_left.T @ two) >= least_z * np.sqrt(one_spread.T @ two + 1)
            if a == b:
                np.fill_diagonal(strong, False)
            told[a : a + block] |= strong.any(1)
            told[b : b + block] |= strong.any(0)
    return keep[told]
