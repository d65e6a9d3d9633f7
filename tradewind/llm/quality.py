"""Quality rules and a calibrated n-gram classifier.

The base rules count words, symbols, repeated lines and repeated three-word windows over the whole text.  The
classifier is a logistic regression on hashed word uni- and bigrams and byte 4-grams, log-damped and scaled to the
length of the text; its margins are turned into probabilities by Platt scaling on a part of the sample that the
fit has not seen.  Scoring runs in Arrow batches; a text is kept if no base rule fails it and its
probability of good quality reaches ``THRESHOLD``.

The fit reads at most ``SAMPLE_ROWS`` labelled rows.  Defined cases: a null text has no words and fails; without
labels, or with one class only, the probability is 1 for every text; a class with a single text is not calibrated; repeated rows get equal results; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tradewind.llm.common import WORD_SPACE, by_batch, stored, texts
from tradewind.llm.sampling import fit_logistic, sample_texts

SAMPLE_ROWS = 5_000
BITS = 16
THRESHOLD = 0.5
CACHED_WORDS = 300_000
SYMBOLS = b"#*$%&|<>"
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class Hashes(dict):
    """Bounded cache of 64-bit word hashes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def repeated_words(h: np.ndarray) -> int:
    """Number of words inside three-word windows that occur twice or more, first ones included."""
    if len(h) < 4:
        return 0
    windows = (h[:-2] * _ODD[0] + h[1:-1]) * _ODD[1] + h[2:] * _ODD[2]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(h), bool)
    for shift in range(3):
        covered[shift: shift + len(again)] |= again
    return int(covered.sum())


def base_counts(raw: bytes, words: list[bytes], h: np.ndarray) -> tuple[int, ...]:
    chars = sum(map(len, words)) - sum(len(w) - len(w.decode()) for w in words) if not raw.isascii() else sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.strip(WORD_SPACE)]
    return (len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(h))


def features(raw: bytes, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of one text and their damped weights; words and bytes fill halves of the table."""
    shift = np.uint64(64 - BITS + 1)
    words = np.concatenate([h * _ODD[0], (h[:-1] * _ODD[1] + h[1:]) * _ODD[2]]) >> shift if len(h) else h
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    grams = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24 if len(b) > 3 else b[:0]
    grams = ((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS + 1)).astype(np.uint64) + np.uint64(1 << BITS - 1)
    at, counts = [], []
    for part in (words, grams):
        found = np.bincount(part.astype(np.int64), minlength=1)
        used = np.flatnonzero(found)
        value = np.log1p(found[used])
        at.append(used)
        counts.append(value / max(np.sqrt((value * value).sum()), 1e-9))
    return np.concatenate(at), np.concatenate(counts)


class Model:
    """Weights of the hashed n-grams and the two numbers of the calibration."""

    def __init__(self, weights: np.ndarray | None = None, bias: float = 0.0, slope: float = 0.0, offset: float = 30.0):
        self.weights = np.zeros(1 << BITS) if weights is None else weights
        self.bias, self.slope, self.offset = bias, slope, offset

    def probability(self, at: np.ndarray, value: np.ndarray) -> float:
        margin = float(self.weights[at] @ value) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def split_words(text: str, hashes: Hashes) -> tuple[bytes, list[bytes], np.ndarray]:
    raw = text.encode()
    words = raw.split()
    return raw, words, hashes.of(words)


def platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, by Newton steps on smoothed targets."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        d, w = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * margins).sum() + 1e-3 * (slope - 1), d.sum()])
        hess = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        slope, offset = slope - np.clip(step[0], -1, 1), offset - np.clip(step[1], -1, 1)
    return float(slope), float(offset)


def spare_fifth(labels: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The rows that calibrate: of each class the fifth with the least hash of the text, one of two to four; equal texts stay together."""
    spare = np.zeros(len(labels), bool)
    for label in set(labels):
        own = labels == label
        hashes = np.unique(order[own])
        if len(hashes) > 1:
            spare |= own & np.isin(order, hashes[: max(1, len(hashes) // 5)])
    return spare


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``rows`` labelled documents; a fifth of them calibrates."""
    sample = stored(sample_texts(docs, labels, "quality", rows), "quality-sample")

    def hashed(batch: pa.RecordBatch, hashes: Hashes) -> pa.RecordBatch:
        found = []
        for text in batch.column(1).to_pylist():
            raw, _, h = split_words(text, hashes)
            found.append((*features(raw, h), xxhash.xxh64_intdigest(raw)))
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([x[0].astype(np.int32) for x in found], pa.list_(pa.int32())),
            pa.array([x[1].astype(np.float32) for x in found], pa.list_(pa.float32())), pa.array([x[2] for x in found], pa.uint64()).view(pa.int64())],
            names=["label", "found", "value", "order"])

    seen = by_batch(sample, "label int, found array<int>, value array<float>, order long", hashed, Hashes).toArrow()
    y = seen["label"].to_numpy().astype(float)
    if len(set(y)) < 2:
        return Model()
    spare = spare_fifth(y, seen["order"].to_numpy())
    at, value = ([np.asarray(x.values) for x in seen[name]] for name in ("found", "value"))
    own, rest = np.flatnonzero(~spare), np.flatnonzero(spare)
    weights, bias = fit_logistic([at[i] for i in own], [value[i] for i in own], y[own], 1 << BITS, 1e-6, 60, 0.1)
    if len(set(y[spare])) < 2:
        return Model(weights, bias, 1.0, 0.0)
    margins = np.array([float(weights[at[i]] @ value[i]) + bias for i in rest])
    return Model(weights, bias, *platt(margins, y[spare]))


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and the calibrated ``probability`` of every row."""

    def work(batch: pa.RecordBatch, hashes: Hashes) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            raw, words, h = split_words(text, hashes)
            counts = base_counts(raw, words, h)
            failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
            p = model.probability(*features(raw, h))
            rows.append((*counts, failed, not failed and p >= threshold, p))
        kinds = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64()]
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["doc_id", *names])

    return by_batch(texts(docs), f"doc_id long, {COUNTS}, base_failed boolean, kept boolean, probability double", work, Hashes)


def quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    return score_quality(docs, fit(docs, labels, rows))
