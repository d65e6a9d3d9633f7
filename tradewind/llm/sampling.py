"""Bounded labelled samples and a small logistic regression for the classifiers of this subpackage.

``rows`` is the documented bound of every sample: at most so many labelled documents, taken in the order of a hash
of their id, reach a fit.  Scoring always covers every row and whole texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import labelled_sample, texts


def sample_texts(docs: DataFrame, labels: DataFrame, column: str, rows: int, rule=None, shares: bool = False) -> DataFrame:
    """``label, text`` of the sampled documents; the ids number at most ``rows``, so they can be broadcast."""
    ids = labelled_sample(labels, column, rows, rule, shares)
    kind = "string" if dict(labels.dtypes)[column] == "string" else "int"
    picked = docs.sparkSession.createDataFrame([(r.doc_id, r.label) for r in ids], f"picked long, label {kind}")
    return texts(docs).join(F.broadcast(picked), F.col("doc_id") == F.col("picked")).select("label", "text")


def letter_words(sample: DataFrame) -> DataFrame:
    """Each document's distinct lower-case words of letters, one per row, with its label."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    return sample.select("label", F.explode(words).alias("word")).where("word <> ''")


def distinct_stories(sample: DataFrame) -> DataFrame:
    """One sampled text for each label and longest word, so that near copies do not vouch for each other's rare words."""
    longest = F.array_max(F.transform(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.struct(F.length(w), w.alias("word"))))["word"]
    return sample.withColumn("longest", longest).groupBy("label", "longest").agg(F.min("text").alias("text")).select("label", "text")


ROWS_PER_STEP = 256


def fit_logistic(
    features: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, size: int, penalty: float, steps: int, rate: float
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on sparse rows; classes weigh alike.

    The rows are held once, in 32-bit numbers, and worked through in pieces.
    """
    pieces = []
    for first in range(0, len(features), ROWS_PER_STEP):
        rows = features[first: first + ROWS_PER_STEP]
        owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in rows])
        at = np.concatenate([np.asarray(x, np.int32) for x in rows])
        value = np.concatenate([np.asarray(x, np.float32) for x in values[first: first + ROWS_PER_STEP]])
        pieces.append((owner, at, value, labels[first: first + ROWS_PER_STEP]))
    del features, values
    positive = max(labels.sum(), 1)
    good, bad = len(labels) / (2 * positive), len(labels) / (2 * max(len(labels) - positive, 1))
    w, bias = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        g, gb = penalty * w, 0.0
        for owner, at, value, truth in pieces:
            z = np.bincount(owner, weights=w[at] * value, minlength=len(truth)) + bias
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth) * np.where(truth == 1, good, bad) / len(labels)
            g += np.bincount(at, weights=error[owner] * value, minlength=size)
            gb += error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias = bias - rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    return w, float(bias)
