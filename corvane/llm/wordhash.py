"""Words of Arrow string columns as 64-bit hashes, without a Python object for each word.

A word's hash is a polynomial of its bytes modulo 2^64, read off prefix sums and mixed by an avalanche function. Texts are
worked on in runs of whole rows of about a megabyte, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
RUN_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes between words: ASCII white space, or all ASCII but letters and digits.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
PUNCT = np.ones(256, bool)
PUNCT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(RUN_BYTES * 2, n)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit integers (splitmix finalizer)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def runs(raw: np.ndarray, at: np.ndarray, size: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of successive runs of whole rows."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        last = min(last, n)
        yield first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_spans(raw: np.ndarray, at: np.ndarray, between: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each row the index of its first word (one more entry at the end)."""
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_not(between[raw], out=inside[1:-1])
    starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cut = at[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    starts[cut] = inside[cut + 1]
    ends[cut - 1] = inside[cut]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    values = (LOWER[raw] if lower else raw).astype(np.uint64)
    values += np.uint64(1)
    values *= up[: len(raw)]
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(raw: np.ndarray, at: np.ndarray, between: np.ndarray = BLANK, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and each row's first word."""
    starts, ends, first = word_spans(raw, at, between)
    return span_hashes(raw, starts, ends, lower), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each window of `size` words inside a row; a row of fewer words gives its whole sequence as one.
    Returns (row, hash), in order of rows; a shingle can repeat."""
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    salts = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_BASE))
    n = len(words)
    out_rows, out = [], []
    if n >= size:
        h = words[: n - size + 1] * (salts[0] | np.uint64(1))
        for k in range(1, size):
            h = mix(h) + words[k : n - size + 1 + k] * (salts[k] | np.uint64(1))
        whole = rows[: n - size + 1] == rows[size - 1 :]
        out_rows.append(rows[: n - size + 1][whole])
        out.append(mix(h[whole]))
    for r in np.flatnonzero((counts > 0) & (counts < size)):
        h = np.uint64(counts[r])
        with np.errstate(over="ignore"):
            for w in words[first[r] : first[r + 1]]:
                h = mix(np.array([h]))[0] + w
        out_rows.append(np.array([r]))
        out.append(mix(np.array([h ^ np.uint64(0xA5A5A5A5)])))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out)


def distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted by row and value."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[keep], values[keep]


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows of `values`; first: where each group begins, and the end. Empty groups give 0."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0)
    return out
