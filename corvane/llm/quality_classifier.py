"""Ordinal quality by cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(theta_k - w.x): one weight for each hashed term, shared by all grades, and ordered thresholds.
From the chain of probabilities follow the expected grade and the tail probability of a grade or better, by which
documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table
from .terms import SAMPLE_ROWS, TERM_BITS, compact, labelled_terms, terms_of
from .wordhash import row_sums

#: Shape of a text, as terms beside the hashed ones: share of distinct terms among all, in twentieths; length by powers of two.
SHAPES = 21 + 24


def _shapes(n_terms: np.ndarray, n_all: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spread = np.where(n_all > 0, 20 * n_terms // np.maximum(n_all, 1), 20)
    return spread.astype(np.int64), 21 + np.minimum(np.log2(np.maximum(n_all, 1)).astype(np.int64), 23)


@dataclass
class CumulativeLink:
    """weights: of dense terms (0 unused), then of shapes. theta: ordered thresholds between successive grades."""

    bits: int
    number: np.ndarray
    grades: list[int]
    weights: np.ndarray
    theta: np.ndarray

    def level(self, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        first = np.searchsorted(rows, np.arange(n + 1))
        spread, length = _shapes(np.diff(first), row_sums(counts, first))
        value = np.log1p(counts).astype(np.float64)
        norm = np.sqrt(np.maximum(row_sums(value * value, first), 1e-9))
        base = len(self.weights) - SHAPES
        return row_sums(self.weights[self.number[terms]] * value, first) / norm + self.weights[base + spread] + self.weights[base + length]

    def tails(self, texts: pa.Array) -> np.ndarray:
        """For each text P(grade >= k) of each grade but the lowest."""
        level = self.level(*terms_of(texts, self.bits, symbols=True), len(texts))
        return 1 / (1 + np.exp(np.clip(self.theta[None, :] - level[:, None], -30, 30)))


def fit_ordinal(terms: list[np.ndarray], counts: list[np.ndarray], ratings: np.ndarray, *, bits: int = TERM_BITS, least_rows: int = 4, epochs: int = 15, batch: int = 128, rate: float = 0.1, l2: float = 1e-4, seed: int = 7) -> CumulativeLink:
    """Cumulative-link likelihood by AdaGrad. Thresholds are a first value and positive steps, so they stay ordered.
    One grade or none: no thresholds, and every text gets that grade (0 if none)."""
    grades = sorted({int(x) for x in ratings}) or [0]
    number, n = compact(terms, bits, least_rows)
    w, k = np.zeros(n + 1 + SHAPES), len(grades) - 1
    model = CumulativeLink(bits, number, grades, w, np.zeros(k))
    if not k:
        return model
    y = np.searchsorted(grades, ratings)
    share = np.clip(np.array([(y <= g).mean() for g in range(k)]), 1e-3, 1 - 1e-3)
    cuts = np.log(share / (1 - share))
    a, steps = cuts[0], np.log(np.maximum(np.diff(cuts), 1e-2))
    dense, value, extra = [], [], []
    for t, c in zip(terms, counts, strict=True):
        v = np.log1p(c)
        v = v / np.sqrt(max(float((v * v).sum()), 1e-9))
        spread, length = _shapes(np.array([len(t)]), np.array([c.sum()]))
        d = number[t]
        dense.append(np.concatenate([d[d > 0], n + 1 + spread, n + 1 + length]))
        value.append(np.concatenate([v[d > 0], [1.0, 1.0]]))
    rng = np.random.default_rng(seed)
    aw, aa, asteps = np.full_like(w, 1e-6), 1e-6, np.full(len(steps), 1e-6)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for b in range(0, len(order), batch):
            part = order[b : b + batch]
            idx, val = np.concatenate([dense[i] for i in part]), np.concatenate([value[i] for i in part])
            first = np.cumsum([0, *(len(dense[i]) for i in part)])
            level = row_sums(w[idx] * val, first)
            theta = np.concatenate([[-np.inf], a + np.concatenate([[0], np.cumsum(np.exp(steps))]), [np.inf]])
            hi, lo = sig(theta[y[part] + 1] - level), sig(theta[y[part]] - level)
            p = np.maximum(hi - lo, 1e-9)
            dhi, dlo = hi * (1 - hi) / p / len(part), lo * (1 - lo) / p / len(part)  # of the log likelihood, by each threshold
            gw = np.bincount(idx, weights=np.repeat(dhi - dlo, np.diff(first)) * val, minlength=len(w)) + l2 * w
            gt = np.bincount(y[part] + 1, weights=-dhi, minlength=k + 2)[1 : k + 1] + np.bincount(y[part], weights=dlo, minlength=k + 2)[1 : k + 1]
            ga, gs = gt.sum(), np.array([gt[j + 1 :].sum() for j in range(k - 1)]) * np.exp(steps)
            aw += gw * gw
            aa += ga * ga
            asteps += gs * gs
            w -= rate * gw / np.sqrt(aw)
            a -= rate * ga / aa**0.5
            steps -= rate * gs / np.sqrt(asteps)
            w[0] = 0
    model.theta = a + np.concatenate([[0], np.cumsum(np.exp(steps))])
    return model


def learn_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, *, id_col: str = "doc_id", text_col: str = "text", rating_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> CumulativeLink:
    """Fits on at most sample_rows rated rows (those with the smallest hash of their id) for which `learn` holds."""
    terms, counts, y = labelled_terms(docs, labels, id_col=id_col, text_col=text_col, label_col=rating_col, learn=F.lit(True) if learn is None else learn, sample_rows=sample_rows, symbols=True)
    return fit_ordinal(terms, counts, y)


def grade_quality(docs: DataFrame, model: CumulativeLink, *, id_col: str = "doc_id", text_col: str = "text", least_grade: int | None = None, least_tail: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, expected_grade, tail_probability (of least_grade or better; the second-lowest
    grade by default), kept (that probability is at least least_tail).

    A null or empty text is graded by the thresholds and the shape of an empty text alone. Ids may be null or repeat,
    equal texts get equal grades, other columns are ignored, and an empty table gives an empty result.
    """
    grades = model.grades
    wanted = grades[min(1, len(grades) - 1)] if least_grade is None else least_grade
    place = next((k for k, g in enumerate(grades) if g >= wanted), len(grades))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.diff(np.array(grades, np.float64))
        for batch in it:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                tails = sent.value.tails(part.column(1))
                tail = np.ones(len(tails)) if place == 0 else tails[:, place - 1] if place <= len(steps) else np.zeros(len(tails))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(grades[0] + tails @ steps), pa.array(tail)], names=["doc_id", "expected_grade", "tail_probability"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, expected_grade double, tail_probability double").withColumn("kept", F.col("tail_probability") >= least_tail)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_quality(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return grade_quality(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "expected_grade", "tail_probability", "kept")
