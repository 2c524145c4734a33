"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text is reduced to a fixed vector of transformed statistics.  Class means and
covariances come from summed moments of the labelled rows; each covariance is
shrunk towards the pooled one and towards its diagonal, and its Cholesky factor is
kept, so that a score is the difference of two Mahalanobis log densities.

Very long texts are measured whole.  Null and empty texts get the statistics of an empty text (all zero counts) and a
score like any other row.  Repeated rows are scored once each.  Columns other than
``doc_id`` and ``text`` are ignored by scoring.  With no training row of one class
the score is the prior (0.5 without any label).  An empty table gives an empty result.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatstream.llm.common import held_out, training_sizes, training_texts

# character classes
LOWER, UPPER, DIGIT, SPACE, STOP, BAR, BANG, SYMBOL, OTHER = range(9)


def _char_classes() -> np.ndarray:
    """Class of every code point of the basic plane (others count as OTHER)."""
    out = np.full(0x10000, OTHER, np.uint8)
    for i in range(0x3000):
        c = chr(i)
        out[i] = (SPACE if c.isspace() else DIGIT if c.isdigit() else UPPER if c.isupper()
                  else LOWER if c.isalpha() else STOP if c in ".,;:?'\"-()" else BAR if c == "|"
                  else BANG if c == "!" else SYMBOL)
    return out


_CLASSES: list[np.ndarray] = []


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one text (shares on a logit scale, sizes on a log scale)."""
    text = text or ""
    if not _CLASSES:
        _CLASSES.append(_char_classes())
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    count = np.bincount(_CLASSES[0][np.minimum(codes, 0xFFFF)], minlength=9)
    words = text.split()
    n, w = max(len(text), 1), max(len(words), 1)
    letters = max(int(count[LOWER] + count[UPPER]), 1)
    lines = text.split("\n")
    distinct = set(words)
    twice = sum(map(operator.eq, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    short = sum(len(x) <= 3 for x in distinct)

    def share(part: float, whole: float) -> float:
        return float(np.log((part + 0.5) / (whole - part + 0.5))) if whole >= part else 0.0

    return [
        float(np.log1p(len(text))),
        float(np.log((n - count[SPACE] + 1) / w)),
        share(count[UPPER], letters),
        share(count[DIGIT], n),
        share(count[SPACE], n),
        share(count[STOP], n),
        share(count[BAR], n),
        share(count[BANG], n),
        share(count[SYMBOL] + count[OTHER], n),
        float(np.log((len(distinct) + 1) / np.sqrt(w + 1))),
        share(twice, w),
        float(np.log((pairs + 1) / (w + 1))),
        share(short, max(len(distinct), 1)),
        float(np.log((len(set(lines)) + 1) / (len(lines) + 1))),
        float(np.log1p(n / len(lines))),
    ]


SIZE = 15


@dataclass
class QualityModel:
    """Means, inverse Cholesky factors and log determinants of both classes."""

    mean: np.ndarray      # (2, d)
    inverse: np.ndarray   # (2, d, d): inverse of the lower Cholesky factor
    logdet: np.ndarray    # (2,)
    log_prior: float      # log P(1) / P(0)
    temper: float         # scale of the log-density difference

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if not len(self.mean):
            return np.full(len(x), self.log_prior)
        dens = [-0.5 * (((x - m) @ inv.T) ** 2).sum(1) - 0.5 * ld
                for m, inv, ld in zip(self.mean, self.inverse, self.logdet, strict=True)]
        return self.log_prior + self.temper * (dens[1] - dens[0])


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Upper triangle of sum(z z') per class with z = (1, statistics): one small block per task."""
    total = np.zeros((2, SIZE + 1, SIZE + 1))
    for b in batches:
        z = np.array([[1.0, *statistics(t)] for t in b["text"]]).reshape(-1, SIZE + 1)
        for c in (0, 1):
            part = z[b["label"].to_numpy() == c]
            total[c] += part.T @ part
    c, i, j = np.nonzero(np.triu(np.ones((SIZE + 1, SIZE + 1)))[None].repeat(2, 0))
    yield pd.DataFrame({"c": c, "i": i, "j": j, "v": total[c, i, j]})


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows_per_class: int = 20_000,
                to_pooled: float = 0.1, to_diagonal: float = 0.05, temper: float = 0.5) -> QualityModel:
    """Fit on at most ``max_rows_per_class`` labelled rows of each class (documented bound).

    The bound holds for means and covariances only: the prior and the classes' parts in the
    pooled covariance come from all labelled rows, so that they don't change with the bound.
    Only 2 * (d + 1)(d + 2) / 2 sums reach the driver, whatever the input.  ``to_pooled``
    and ``to_diagonal`` are the shrinkage intensities; ``temper`` scales the log-density
    difference, as the statistics are not independent draws.
    """
    rows = (training_texts(docs, labels, label, max_rows_per_class).select("text", "label")
            .mapInPandas(_moments, "c long, i long, j long, v double")
            .groupBy("c", "i", "j").agg(F.sum("v").alias("v")).collect())
    m = np.zeros((2, SIZE + 1, SIZE + 1))
    for r in rows:
        m[r.c, r.i, r.j] = m[r.c, r.j, r.i] = r.v
    n = m[:, 0, 0]
    size = np.array(training_sizes(docs, labels, label), np.float64)
    prior = float(np.log((size[1] + 1) / (size[0] + 1)))
    if min(n) < 2:
        return QualityModel(np.zeros((0, SIZE)), np.zeros((0, SIZE, SIZE)), np.zeros(0), prior, temper)
    mean = m[:, 0, 1:] / n[:, None]
    cov = np.array([m[c, 1:, 1:] / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)])
    pooled = (size[:, None, None] * cov).sum(0) / size.sum()
    inverse, logdet = [], []
    for c in (0, 1):
        s = (1 - to_pooled) * cov[c] + to_pooled * pooled
        s = (1 - to_diagonal) * s + to_diagonal * np.diag(np.diag(s)) + 1e-3 * np.eye(SIZE)
        low = np.linalg.cholesky(s)
        inverse.append(np.linalg.inv(low))
        logdet.append(2 * np.log(np.diag(low)).sum())
    return QualityModel(mean, np.array(inverse), np.array(logdet), prior, temper)


def quality_score(text: Column, model: QualityModel) -> Column:
    """Score column in 0..1; the small model travels with the function."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            x = np.array([statistics(t) for t in s]).reshape(-1, SIZE)
            yield pd.Series(1 / (1 + np.exp(-np.clip(model.log_odds(x), -60, 60))))

    return score(text)


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    return (docs.select("doc_id", held_out().alias("held_out"), quality_score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, in their own columns."""
    return docs.where(quality_score(F.col("text"), model) >= threshold)
