"""Document quality by a regularised quadratic discriminant.

Each text becomes a short vector of transformed statistics. Each class is a Gaussian whose
covariance is shrunk towards its diagonal; a score is the logistic of the difference of the two
log-densities, from Mahalanobis distances through Cholesky factors that are computed once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import stored, text_batches

FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "digits", "marks", "odd_marks", "spaces",
    "line_breaks", "distinct_words", "distinct_pairs", "lone_marks", "entropy",
)
SHRINKAGE = 0.1   # weight of the covariance's own diagonal
FLOOR = 1e-3      # least variance of a feature
FOLDS = 3
HELD_OUT = 1      # remainder of crc32(doc_id) that is never learnt from

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_MARK = ~(_UPPER | _DIGIT | _LETTER | _SPACE)
_PLAIN = np.isin(_BYTES, [ord(c) for c in ".,;:?'\"()-"])


def statistics(text: bytes | None) -> list[float]:
    """The transformed statistics of one UTF-8 text, in the order of FEATURES; whole text, null as
    empty. Shares are taken as logits of smoothed counts, sizes as logarithms."""
    raw = text or b""
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    # bytes that continue a character are not counted as characters
    counts[128:192] = 0
    chars = int(counts.sum())
    words = raw.split()
    n = len(words)
    pairs = len(set(zip(words, words[1:])))
    share = counts[counts > 0] / max(chars, 1)
    lone = sum(map(_LONE.__contains__, words))

    def logit(part: float, whole: float) -> float:
        return math.log((part + 0.5) / (whole - part + 0.5))

    return [
        math.log1p(chars), math.log1p(n), math.log1p(chars / max(n, 1)),
        logit(counts[_UPPER].sum(), chars), logit(counts[_DIGIT].sum(), chars),
        logit(counts[_MARK].sum(), chars), logit(counts[_MARK & ~_PLAIN].sum(), chars),
        logit(counts[_SPACE].sum(), chars), logit(counts[10], chars),
        logit(len(set(words)), n), logit(pairs, max(n - 1, 0)), logit(lone, n),
        float(-(share * np.log(share)).sum()),
    ]


_LONE = frozenset(bytes([b]) for b in _BYTES[_MARK])


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and log normalisers of the classes 0 and 1, in that order."""

    means: np.ndarray
    whiten: np.ndarray
    offset: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        logs = []
        for mean, whiten, offset in zip(self.means, self.whiten, self.offset):
            z = (x - mean) @ whiten.T
            logs.append(offset - 0.5 * (z * z).sum(axis=1))
        gap = np.clip(logs[1] - logs[0], -700, 700)
        return 1 / (1 + np.exp(-gap))


def fold(doc_id: Column) -> Column:
    """The remainder of crc32 of the id as text; null for a null id."""
    return F.crc32(doc_id.cast("string")) % FOLDS


def features(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, and x, the statistics of its whole text."""
    text_batches(documents.sparkSession)

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t) for t in texts])

    return documents.select("doc_id", measured(F.col("text").cast("binary")).alias("x"))


def fit(measured: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Model:
    """Learn the classes from the labelled rows outside the held-out fold.

    Sums, not rows, come to the driver: d + d(d+1)/2 numbers per class. Labels that are null or
    neither 0 nor 1 are ignored, and so is a document whose labels contradict one another; a label
    row that is there twice counts once. A class without rows takes the moments of the other; with
    no labels at all every score is 1/2.
    """
    known = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("y"), F.max("quality").alias("top")
    ).where("y = top").where(fold(F.col("doc_id")) != HELD_OUT).drop("top")
    rows = measured.join(known, "doc_id").select("x", "y")
    d = len(FEATURES)
    at = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = rows.groupBy("y").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(d)]).alias("s"),
        F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in at]).alias("ss"),
    ).collect()
    found = {}
    for row in sums:
        mean = np.array(row["s"]) / row["n"]
        second = np.zeros((d, d))
        for (i, j), v in zip(at, row["ss"]):
            second[i, j] = second[j, i] = v / row["n"]
        cov = second - np.outer(mean, mean)
        spread = np.diag(np.maximum(np.diag(cov), FLOOR))
        weight = min(1.0, shrinkage + d / (d + row["n"]))
        found[row["y"]] = (row["n"], mean, (1 - weight) * cov + weight * spread)
    return _model(found, d)


def _model(found: dict, d: int) -> Model:
    total = sum(n for n, _, _ in found.values())
    means, whiten, offset = [], [], []
    for y in (0, 1):
        n, mean, cov = found.get(y) or found.get(1 - y) or (0, np.zeros(d), np.eye(d))
        n = found[y][0] if y in found else 0
        cov = cov + np.eye(d) * FLOOR
        factor = np.linalg.cholesky(cov)
        means.append(mean)
        whiten.append(np.linalg.inv(factor))
        offset.append(math.log((n + 0.5) / (total + 1)) - np.log(np.diag(factor)).sum())
    return Model(np.array(means), np.array(whiten), np.array(offset))


def scored(measured: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `features`."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    return measured.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        score("x").alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A quality score for every row of `documents`, whatever its text; see `fit` for the labels.

    A null text is an empty one, and an empty text is scored like any other. A row with a null id
    is scored, not learnt from and not held out. Repeated rows are scored each. Other columns of
    either table are not looked at. An empty table gives an empty result.
    """
    measured = stored(features(documents), "quality")
    return scored(measured, fit(measured, labels))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `documents` that the classifier predicts to be of class 1, columns unchanged.

    The texts are scored where they are read, so they are not shuffled.
    """
    model = fit(stored(features(documents), "quality"), labels)

    @F.pandas_udf("boolean")
    def good(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([statistics(t) for t in texts]).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(x) >= 0.5)

    return documents.where(good(F.col("text").cast("binary")))
