"""Language identification as inference in a mixture of languages.

Each learned language is a distribution of byte trigrams. A document is a mixture: each of its words comes from one
language, and expectation-maximisation estimates the shares. The set of languages is chosen by penalised likelihood: the
likelihood of the best one, two, three ... up to all languages, less half the logarithm of the number of words for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table
from .wordhash import LOWER, PUNCT, buffers, row_sums, runs, word_spans

GRAM_BITS = 15
ROUNDS = 10
_MULTIPLIER = np.uint32(0x9E3779B1)


def _gram_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of all words in order (a word has a blank on each side), the first trigram of each word, and
    each row's first word. Words are runs of letters and digits; those of digits alone count as any other."""
    starts, ends, first = word_spans(raw, at, PUNCT)
    length = ends - starts
    begin = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.int64), begin, first
    padded = np.zeros(len(raw) + 2, np.uint32)
    padded[1:-1] = np.where(PUNCT[raw], 32, LOWER[raw])
    places = np.arange(begin[-1]) + np.repeat(starts - begin[:-1], length)
    left, mid, right = padded[places], padded[places + 1], padded[places + 2]
    left[begin[:-1]] = 32
    right[begin[1:] - 1] = 32
    gram = (left | (mid << np.uint32(8)) | (right << np.uint32(16))) * _MULTIPLIER
    return (gram >> np.uint32(32 - GRAM_BITS)).astype(np.int64), begin, first


@dataclass
class LanguageModel:
    """log_p: for each gram (rows) and language (columns) the logarithm of its probability."""

    languages: list[str]
    log_p: np.ndarray

    def infer(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each text the shares of the languages (0 outside the chosen set) and its number of words."""
        raw, at = buffers(texts)
        shares, n_words = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for a, b, part, offsets in runs(raw, at):
            grams, begin, first = _gram_spans(part, offsets)
            scores = np.zeros((len(begin) - 1, len(self.languages)), np.float32)
            for lang in range(len(self.languages)):  # by column, to keep the gathered values small
                scores[:, lang] = row_sums(self.log_p[:, lang][grams], begin)
            shares[a:b], n_words[a:b] = choose(scores, first), np.diff(first)
        return shares, n_words


def _em(likely: np.ndarray, top: np.ndarray, first: np.ndarray, row: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log likelihood of each row's mixture over its allowed languages."""
    n = np.maximum(np.diff(first), 1)[:, None]
    share = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    for _ in range(ROUNDS):
        part = likely * share[row]
        part /= np.maximum(part.sum(1, keepdims=True), 1e-30)
        share = row_sums(part, first) / n
    total = np.log(np.maximum((likely * share[row]).sum(1), 1e-30)) + top
    return share, row_sums(total, first)


def choose(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """scores: log likelihood of each word in each language; first: each row's first word. Shares by row."""
    rows, k = len(first) - 1, scores.shape[1]
    if not k:
        return np.zeros((rows, 0))
    row = np.repeat(np.arange(rows), np.diff(first))
    top = scores.max(1) if len(scores) else np.zeros(0, np.float32)
    likely = np.exp(scores - top[:, None])
    shares, of_all = _em(likely, top, first, row, np.ones((rows, k), np.float32))
    rank = np.argsort(np.argsort(-shares, axis=1, kind="stable"), axis=1, kind="stable")
    cost = 0.5 * np.log(np.maximum(np.diff(first), 2))
    best, best_value = np.zeros((rows, k)), np.full(rows, -np.inf)
    for size in range(1, k + 1):
        share, value = _em(likely, top, first, row, (rank < size).astype(np.float32)) if size < k else (shares, of_all)
        value = value - size * cost
        better = value > best_value
        best[better], best_value[better] = share[better], value[better]
    return best


def learn_languages(docs: DataFrame, learn: Column | None = None, *, text_col: str = "text", lang_col: str = "lang", smooth: float = 0.5) -> LanguageModel:
    """Counts the trigrams of every text with a non-null language for which `learn` (over the columns of docs) holds.

    Counts are added up on the executors; what reaches the driver is at most 2^GRAM_BITS numbers for each language.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in it:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            raw, at = buffers(texts)
            for a, b, part, offsets in runs(raw, at):
                grams, begin, first = _gram_spans(part, offsets)
                ends = begin[first]
                for r in range(b - a):
                    own = counts.setdefault(langs[a + r], np.zeros(1 << GRAM_BITS, np.int64))
                    if ends[r + 1] - ends[r] > 4096:
                        own += np.bincount(grams[ends[r] : ends[r + 1]], minlength=1 << GRAM_BITS)
                    else:
                        np.add.at(own, grams[ends[r] : ends[r + 1]], 1)
        for lang, own in counts.items():
            seen = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(seen), pa.string()), "gram": pa.array(seen.astype(np.int32)), "n": pa.array(own[seen])})

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.where(learn) if learn is not None else rows
    counted = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(batches, "lang string, gram int, n long")
    found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    table_ = np.full((1 << GRAM_BITS, len(langs)), smooth)
    column = {x: k for k, x in enumerate(langs)}
    np.add.at(table_, (found["gram"].to_numpy(), np.array([column[x] for x in found["lang"].to_pylist()], np.int64)), found["n"].to_numpy())
    return LanguageModel(langs, np.log(table_ / table_.sum(0)).astype(np.float32))


def identify_languages(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (the share of that language), lang_set (chosen, by share).

    A text that is null or has no letter gets `und`, score 0 and an empty set, as does every text when no language was
    learned. Equal shares go to the language that is first in order. Ids may be null or repeat, other columns are ignored,
    and an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in it:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                shares, _ = m.infer(part.column(1))
                letters = part.column(2).to_pylist()
                order = np.argsort(-shares, axis=1, kind="stable")
                pred, score, chosen = [], [], []
                for r, has in enumerate(letters):
                    top = [c for c in order[r] if shares[r, c] > 0] if has else []
                    if has and m.languages and not top:
                        top = [0]
                    pred.append(m.languages[top[0]] if top else "und")
                    score.append(min(1.0, float(shares[r, top[0]])) if top else 0.0)
                    chosen.append(",".join(m.languages[c] for c in top))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(chosen, pa.string())], names=["doc_id", "lang_pred", "score", "lang_set"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, lang_set string")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs, fold("doc_id", 4) != 2)
    return identify_languages(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "lang_set")
