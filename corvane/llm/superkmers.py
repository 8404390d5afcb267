"""Runs of equal-length windows that share their minimizer.

Every window of `width` bytes has one minimizer, the leftmost of its `gram`-byte substrings with the smallest hash. Equal
windows have equal minimizers at equal places, so windows dealt by minimizer meet all their equals. Neighbouring
windows mostly share it; such a run, with the bytes that it covers, travels as one string of less than 2 * width bytes.
"""

from __future__ import annotations

import numpy as np

from .wordhash import _power_tables, mix

PLACE_BITS = 24
#: Longer texts are cut into pieces of so many windows; pieces overlap, so that every window lies in one.
PIECE_WINDOWS = 1 << 22


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w successive values: running minima inside blocks of w, from the left and from the right."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def super_runs(raw: np.ndarray, at: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """raw: bytes of successive texts; at: where each begins, and the end. For each run of windows: its text, its first
    window (in bytes of raw), its number of windows, the hash of its minimizer, and the bytes before the minimizer."""
    none = np.zeros(0, np.int64)
    if len(raw) < width:
        return none, none, none, none.astype(np.uint64), none
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    n = len(raw) - gram + 1
    grams = mix((sums[gram:] - sums[:n]) * down[:n])
    mask = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (grams & ~mask) | np.arange(n, dtype=np.uint64)
    low = _sliding_min(ranked, width - gram + 1)
    place = (low & mask).astype(np.int64)
    text = np.searchsorted(at, np.arange(len(low)), "right") - 1
    inside = np.arange(len(low)) + width <= at[text + 1]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(start)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | start[1:]
    ends = np.flatnonzero(stop) + 1
    return text[starts], starts, ends - starts, grams[place[starts]], place[starts] - starts
