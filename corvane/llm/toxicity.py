"""Toxicity by a factorization machine over hashed terms.

score(x) = sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>) over the distinct terms of a text. The pairwise part learns
that an insult together with a mention of a group weighs more than either, which additive weights can't say. It is
computed in linear time as half of (|sum v|^2 - sum |v|^2).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table
from .terms import SAMPLE_ROWS, labelled_terms, telling, telling_in_pairs, terms_of
from .wordhash import row_sums

FACTORS = 8
THRESHOLD = 0.7
BITS = 21
#: Beginnings of words, in bytes, that count as terms of their own.
PREFIXES = (3, 4, 5, 6, 7)
#: Rows whose terms' factors are looked up together on the driver.
ROWS_AT_ONCE = 256


@dataclass
class FactorizationMachine:
    """number: 2^bits to dense term numbers, 0 for terms without a weight. A few megabytes, whatever the input."""

    bits: int
    number: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """terms: dense numbers of all rows in order; first: where each row begins, and the end."""
        v = self.factors[terms]
        s = row_sums(v, first)
        return self.bias + row_sums(self.weights[terms], first) + 0.5 * ((s * s).sum(1) - row_sums((v * v).sum(1), first))

    def score(self, texts: pa.Array) -> np.ndarray:
        rows, terms, _ = terms_of(texts, self.bits, prefixes=PREFIXES, repeated=True, number=self.number)
        return 1 / (1 + np.exp(-np.clip(self.logits(terms, np.searchsorted(rows, np.arange(len(texts) + 1))), -30, 30)))


def _numbers(kept: np.ndarray, bits: int) -> np.ndarray:
    """Dense numbers of these terms, from 1; 0 for all others."""
    number = np.zeros(1 << bits, np.int32)
    number[kept] = np.arange(1, len(kept) + 1)
    return number


def _calibrated(logits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Probabilities by a slope and an intercept fitted to the labels (Newton steps, a little regularised)."""
    a, b = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - labels) * logits).sum() + 1e-2 * (a - 1), (p - labels).sum()])
        h = np.array([[(w * logits * logits).sum() + 1e-2, (w * logits).sum()], [(w * logits).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    return 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))


def fit_fm(terms: list[np.ndarray], labels: np.ndarray, *, bits: int = BITS, least_rows: int = 8, least_z: float = 3.0, least_pair_z: float = 6.0, pair_terms: int = 4096, **how) -> FactorizationMachine:
    """A machine over the terms that tell alone, or in pairs beyond what those say; all others would be learned by heart.

    First the terms whose own rows differ in their rate of label 1 are learned; what they leave unexplained then shows
    the pairs that matter (terms.telling_in_pairs), and the machine is fitted again over both. least_z and least_pair_z are
    standard deviations; pair_terms bounds the terms whose pairs are looked at. No rows: every score is 0.5; one class:
    the base rate.
    """
    alone = telling(terms, labels, bits, least_rows, least_z)
    model = _fit(terms, labels, bits, alone, **how)
    if not len(labels):
        return model
    logits = []
    for k in range(0, len(terms), ROWS_AT_ONCE):  # a term's factors take eight times its own place
        dense = [t[t > 0] for t in (model.number[x] for x in terms[k : k + ROWS_AT_ONCE])]
        logits.append(model.logits(np.concatenate(dense), np.cumsum([0, *map(len, dense)])))
    logits = np.concatenate(logits)
    paired = telling_in_pairs(terms, labels, _calibrated(logits.astype(np.float64), labels), bits, least_rows, least_pair_z, pair_terms)
    both = np.union1d(alone, paired)
    return model if len(both) == len(alone) else _fit(terms, labels, bits, both, **how)


def _fit(terms: list[np.ndarray], labels: np.ndarray, bits: int, kept: np.ndarray, *, factors: int = FACTORS, epochs: int = 40, batch: int = 128, rate: float = 0.1, l2_w: float = 2e-5, l2_v: float = 5e-4, toxic_weight: float = 4.0, seed: int = 7) -> FactorizationMachine:
    """Log loss by AdaGrad over mini-batches in a seeded order; toxic rows, the fewer, weigh toxic_weight times."""
    rng = np.random.default_rng(seed)
    number, n = _numbers(kept, bits), len(kept)
    rate0 = (labels.sum() + 0.5) / (len(labels) + 1)
    model = FactorizationMachine(bits, number, float(np.log(rate0 / (1 - rate0))), np.zeros(n + 1, np.float32), (rng.normal(0, 0.02, (n + 1, factors))).astype(np.float32))
    model.factors[0] = 0
    if not len(labels) or not n:
        return model
    dense = [t[t > 0] for t in (number[x] for x in terms)]
    aw, av, ab = np.full(n + 1, 1e-6, np.float32), np.full((n + 1, factors), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), batch):
            part = order[k : k + batch]
            idx = np.concatenate([dense[i] for i in part])
            first = np.cumsum([0, *(len(dense[i]) for i in part)])
            row = np.repeat(np.arange(len(part)), np.diff(first))
            v = model.factors[idx]
            s = row_sums(v, first)
            logit = model.bias + row_sums(model.weights[idx], first) + 0.5 * ((s * s).sum(1) - row_sums((v * v).sum(1), first))
            g = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[part]).astype(np.float32) / len(part)
            g *= np.where(labels[part] > 0, toxic_weight, 1).astype(np.float32)
            gw = np.bincount(idx, weights=g[row], minlength=n + 1).astype(np.float32)
            gv = np.zeros_like(model.factors)
            np.add.at(gv, idx, g[row][:, None] * (s[row] - v))
            gw += l2_w * model.weights / len(part)
            gv += l2_v * model.factors / len(part)
            aw += gw * gw
            av += gv * gv
            gb = float(g.sum())
            ab += gb * gb
            model.weights -= rate * gw / np.sqrt(aw)
            model.factors -= rate * 0.3 * gv / np.sqrt(av)
            model.bias -= rate * gb / ab**0.5
            model.weights[0], model.factors[0] = 0, 0
    return model


def learn_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Fits on at most sample_rows labelled rows (those with the smallest hash of their id) for which `learn` holds."""
    terms, _, y = labelled_terms(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, learn=F.lit(True) if learn is None else learn, sample_rows=sample_rows, bits=BITS, prefixes=PREFIXES, repeated=True, counted=False)
    return fit_fm(terms, (y > 0).astype(np.int64))


def score_toxicity(docs: DataFrame, model: FactorizationMachine, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 if score >= threshold).

    A null or empty text has no terms; its score is that of the bias. Ids may be null or repeat, equal texts get equal
    scores, other columns are ignored, and an empty table gives an empty result. The model is sent to the executors once;
    its size is fixed by its parameters.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sent.value.score(part.column(1)), pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, model: FactorizationMachine, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below the threshold. Columns may have any names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    t = names.index(text_col)
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                yield part.filter(pa.array(sent.value.score(part.column(t)) < threshold))

    kept = plain.mapInArrow(batches, plain.schema)
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
