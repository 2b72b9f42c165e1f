"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document has one score, the weighted sum of hashed text features. Ordered
thresholds cut the scores into grades: the probability of a grade above ``k`` is the
logistic function of the score less threshold ``k``. All grades share the weights.
Features are words without their punctuation, the look of words (case and
punctuation) and repetition, each as the root of its share of the document, so
long and short texts weigh the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import arrow_map, utf8

FEATURES = 1 << 18
SAMPLE_ROWS = 10_000
MEMO_WORDS = 200_000
_REPEATED, _FIRST = 0, 1
_MARKS = bytes(range(0x21, 0x30)) + b":;<=>?@[\\]^_`{|}~"


class _WordFeatures(dict):
    """Two features of a word in one number: its letters and its look."""

    def __init__(self, features: int):
        super().__init__()
        self._span = features - _FIRST

    def __missing__(self, word: bytes) -> int:
        core = word.strip(_MARKS)
        text = core.decode("utf-8", "replace")
        case = b"U" if len(text) > 1 and text.isupper() else b"l"
        look = case + word[len(word.rstrip(_MARKS)) :][:4] + (b"" if core else b"0")
        letters = xxhash.xxh3_64_intdigest(text.lower().encode()) % self._span + _FIRST
        shape = xxhash.xxh3_64_intdigest(look, seed=1) % self._span + _FIRST
        value = self[word] = letters << 32 | shape
        return value


def text_features(words: list[bytes], memo: _WordFeatures) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of a document and their values; none without words."""
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    if len(memo) > MEMO_WORDS:
        memo.clear()
    both = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
    repeated = int((both[1:] >> 32 == both[:-1] >> 32).sum())
    found, counts = np.unique(np.r_[both >> 32, both & 0xFFFFFFFF], return_counts=True)
    if repeated:
        found, counts = np.r_[_REPEATED, found], np.r_[repeated, counts]
    return found.astype(np.int32), np.sqrt(counts / len(words)).astype(np.float32)


@dataclass
class OrdinalModel:
    """Weights shared by all grades, and thresholds in ascending order."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """Probability of a grade above each threshold, one column per threshold."""
        return _logistic(score[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(
    columns: np.ndarray, values: np.ndarray, starts: np.ndarray, grades: np.ndarray,
    features: int, n_grades: int, steps: int = 150, rate: float = 0.5, ridge: float = 1e-6,
) -> OrdinalModel:
    """Maximum likelihood of the graded documents, by Adam on the whole sample.

    Thresholds are the first one and the logarithms of the gaps to the next, so
    they stay in order. ``starts`` has the first entry of each document.
    """
    n = len(grades)
    rows = np.repeat(np.arange(n), np.diff(np.r_[starts, len(columns)]))
    share = np.clip(np.array([(grades > k).mean() for k in range(n_grades - 1)]), 1e-3, 1 - 1e-3)
    first = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(first), 0.1))
    theta = np.r_[np.zeros(features), first[:1], gaps]
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights, cuts = theta[:features], _cuts(theta[features:])
        score = np.bincount(rows, weights=values * weights[columns], minlength=n)
        # Probability of the grade as a difference of two logistic functions.
        edges = np.r_[-np.inf, cuts, np.inf]
        upper, lower = _logistic(edges[grades + 1] - score), _logistic(edges[grades] - score)
        likely = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        by_score = (up - down) / n
        grad = np.empty_like(theta)
        grad[:features] = np.bincount(columns, weights=values * by_score[rows], minlength=features)
        grad[:features] += ridge * weights
        by_cut = np.array(
            [(down[grades == k + 1].sum() - up[grades == k].sum()) / n for k in range(n_grades - 1)]
        )
        after = np.cumsum(by_cut[::-1])[::-1]
        grad[features] = after[0]
        grad[features + 1 :] = after[1:] * np.exp(theta[features + 1 :])
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        size = rate * (0.1 if step > 0.8 * steps else 1.0)
        theta = theta - size * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return OrdinalModel(theta[:features].astype(np.float32), _cuts(theta[features:]))


def _cuts(free: np.ndarray) -> np.ndarray:
    return free[0] + np.r_[0, np.cumsum(np.exp(free[1:]))]


def train(
    docs: DataFrame, ratings: DataFrame, n_grades: int, id_col: str = "doc_id", text_col: str = "text",
    grade_col: str = "grade", sample_rows: int = SAMPLE_ROWS, features: int = FEATURES,
) -> OrdinalModel:
    """Fit on about ``sample_rows`` rated documents, chosen by a hash of their id.

    ``sample_rows`` bounds what reaches the driver: the feature numbers of that many
    documents. Ratings with a null id or grade, or a grade outside ``0 ..
    n_grades - 1``, are left out; an id with several ratings has its lowest. With
    no usable rating at all the weights are zero.
    """
    usable = ratings.select(
        F.col(f"`{id_col}`").cast("long").alias("rated_id"), F.col(f"`{grade_col}`").cast("int").alias("grade")
    ).where(f"rated_id IS NOT NULL AND grade BETWEEN 0 AND {n_grades - 1}")
    usable = usable.groupBy("rated_id").agg(F.min("grade").alias("grade"))
    total = usable.count()
    parts = max(1, -(-total // sample_rows))
    chosen = usable.where(F.pmod(F.xxhash64("rated_id"), F.lit(parts)) == 0)
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("rated_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).join(F.broadcast(chosen), "rated_id").select("grade", "text")

    def featured(batches) -> Iterator[dict]:
        memo = _WordFeatures(features)
        for batch in batches:
            found = [text_features(t.split() if t else [], memo) for t in utf8(batch.column(1))]
            yield {
                "grade": batch.column(0),
                "columns": [c.tobytes() for c, _ in found], "weights": [v.tobytes() for _, v in found],
            }

    rows = arrow_map(texts, featured, "grade int, columns binary, weights binary").toArrow()
    if not rows.num_rows:
        return OrdinalModel(np.zeros(features, np.float32), np.arange(n_grades - 1, dtype=float))
    parts_of = [np.frombuffer(c, np.int32) for c in rows["columns"].to_pylist()]
    sizes = np.array([len(c) for c in parts_of])
    return fit_ordinal(
        np.concatenate(parts_of),
        np.frombuffer(b"".join(rows["weights"].to_pylist()), np.float32).astype(np.float64),
        np.cumsum(sizes) - sizes, rows["grade"].to_numpy().astype(np.int64), features, n_grades,
    )


def score(
    docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score, expected_grade, tails`` per document, nothing shuffled.

    ``tails[k]`` is the probability of a grade above ``k``; the expected grade is
    their sum. Null, empty and blank texts have score 0. Repeated rows have a row each.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights, model.thresholds))

    def scored(batches) -> Iterator[dict]:
        weights, thresholds = shared.value
        memo, fitted = _WordFeatures(len(weights)), OrdinalModel(weights, thresholds)
        for batch in batches:
            values = np.array(
                [
                    float(weights[c] @ v)
                    for c, v in (text_features(t.split() if t else [], memo) for t in utf8(batch.column(1)))
                ]
            )
            tails = fitted.tails(values) if len(values) else np.empty((0, len(thresholds)))
            yield {
                "doc_id": batch.column(0), "score": values,
                "expected_grade": tails.sum(axis=1), "tails": list(tails),
            }

    return arrow_map(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.col(f"`{text_col}`").cast("string").alias("text"),
        ),
        scored, "doc_id long, score double, expected_grade double, tails array<double>",
    )


def graded_labels(labels: DataFrame) -> DataFrame:
    """Ratings from the two flags: 0 toxic, 1 poor, 2 good. Null flags give no rating."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("toxic").isNull(), None).otherwise(F.col("quality") + 1)
    return labels.select("doc_id", grade.cast("int").alias("grade"))
