"""Ranked lexical search over impact vectors in the order of their length.

A document's vector holds its impact on each term of the items, an item's vector the weights of its terms; the score is
their inner product.  Vectors lie on disk in descending order of their Euclidean length, dealt to tasks by ranges
of it.  The longest ones (about ``HEAD``) are scored first; the score of rank ``k`` that an item reaches there is
its threshold everywhere else.  A task walks its vectors in buckets of falling length: by Cauchy-Schwarz an item leaves
out a bucket whose greatest length times its own stays below its threshold.  Inside a bucket, the exact products of the
item's heaviest coordinates, plus Cauchy-Schwarz over the remaining ones, bound every document; the survivors are scored in
64-bit integers, and raise the item's threshold for the buckets that follow.  Bounds carry a margin for rounding
and drop only what lies strictly below the threshold, so the result is exact, ties included.

Items are the query set; they are taken in blocks of about ``ITEMS`` (dealt by a hash of the id), and only a block's
terms and weights are sent to the tasks, so these stay bounded whatever the number of items.

Defined cases: a text that is null, empty or without a term has no vector and does not count; every row of the documents
is a document, also if ids repeat or are missing (a missing id ranks behind equal scores); the rows of one ``item_id`` are
one item with the terms of all; rows without ``item_id`` form one item without an id; an item without terms, or whose
terms no document has, gives no rows; empty tables give none.  Whole texts are read, however long.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import by_batch, stored, texts

ITEMS = 1024           # items of a block, about
HEAD = 4096            # longest vectors that set the thresholds, about
BUCKET, CELLS = 512, 1 << 21   # rows of a bucket; cells of its dense matrix at most
FOCUS = 8              # heaviest coordinates of an item that are multiplied out first
MARGIN = 1 + 1e-9
# ASCII signs become spaces and A to Z small letters; all other bytes stay, so terms are what a split leaves.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
COUNTED = "doc_id long, n long, terms array<int>, tfs array<int>"
VECTORS = "doc_id long, norm double, terms array<int>, impacts array<long>"
RANKED = "item_id long, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TERMS).split()


def lists(rows: list, kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms``: the distinct terms of every item."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted({t.decode() for t in terms_of(x)}) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), lists(found, pa.string())], names=["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    each = by_batch(rows, "item_id long, terms array<string>", work)
    return each.groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Number of terms of every document that has one, and how often those of the vocabulary occur."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, sizes, terms, tfs = [], [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = terms_of(text)
            if words:
                known = np.fromiter(map(vocabulary.get, words, (-1 for _ in words)), np.int32, len(words))
                term, tf = np.unique(known[known >= 0], return_counts=True)
                ids.append(doc_id), sizes.append(len(words)), terms.append(term), tfs.append(tf.astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), lists(terms, pa.int32()), lists(tfs, pa.int32())],
            names=["doc_id", "n", "terms", "tfs"])

    return by_batch(texts(docs), COUNTED, work)


def impact_vectors(rows: DataFrame, documents: int, length: int) -> DataFrame:
    """The vectors of documents with a term of the vocabulary, and their lengths."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        impacts, norms = [], []
        for n, tfs in zip(batch.column(1).to_pylist(), batch.column(3)):
            tf = tfs.values.to_numpy().astype(np.int64)
            m = 100 - 90 + (90 * n * documents) // length
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * m)
            impacts.append(impact)
            norms.append(math.sqrt(float(np.square(impact.astype(np.float64)).sum())))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(norms, pa.float64()), batch.column(2), lists(impacts, pa.int64())],
            names=["doc_id", "norm", "terms", "impacts"])

    return by_batch(rows.where(F.size("terms") > 0), VECTORS, work)


class Walk:
    """The items of a block on their way through buckets of falling length."""

    def __init__(self, ids: list, terms: list[np.ndarray], weights: np.ndarray, floors: list[int], k: int):
        self.ids, self.terms, self.k = ids, terms, k
        self.weights = [weights[t] for t in terms]
        squares = [np.square(w.astype(np.float64)) for w in self.weights]
        self.norms = np.sqrt(np.array([s.sum() for s in squares]))
        heavy = [np.argsort(-w, kind="stable")[:FOCUS] for w in self.weights]
        self.focus = [t[h] for t, h in zip(terms, heavy)]
        self.focus_weights = [w[h].astype(np.float64) for w, h in zip(self.weights, heavy)]
        self.rest = [math.sqrt(max(s.sum() - s[h].sum(), 0.0)) for s, h in zip(squares, heavy)]
        self.floor = np.maximum(np.array(floors, np.float64), 1)
        self.best: list[list[tuple[int, float]]] = [[] for _ in ids]
        self.rows = max(1, min(BUCKET, CELLS // max(len(weights), 1)))
        self.cells = np.zeros((self.rows, len(weights)), np.int64)

    def visit(self, ids: list, norms: np.ndarray, terms: list[np.ndarray], impacts: list[np.ndarray]) -> None:
        """One bucket; an id that is missing counts as the greatest."""
        row = np.repeat(np.arange(len(ids)), [len(t) for t in terms])
        column = np.concatenate(terms)
        self.cells[row, column] = np.concatenate(impacts)
        cells, square = self.cells[: len(ids)], np.square(norms)
        order = [math.inf if i is None else i for i in ids]
        for at in np.flatnonzero(self.norms * norms.max() * MARGIN >= self.floor):
            part = cells[:, self.focus[at]].astype(np.float64)
            left = np.sqrt(np.maximum(square * MARGIN - np.square(part).sum(axis=1), 0.0))
            bound = (part @ self.focus_weights[at] + self.rest[at] * left) * MARGIN
            alive = np.flatnonzero(bound >= self.floor[at])
            if len(alive):
                self.keep(at, alive, cells[np.ix_(alive, self.terms[at])] @ self.weights[at], order)
        self.cells[row, column] = 0

    def keep(self, at: int, alive: np.ndarray, scores: np.ndarray, order: list) -> None:
        heap = self.best[at]
        for i in np.flatnonzero(scores >= self.floor[at]):
            entry = (int(scores[i]), -order[alive[i]])
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.floor[at] = max(self.floor[at], heap[0][0])

    def result(self) -> pa.RecordBatch:
        rows = [(self.ids[at], None if i == -math.inf else -i, score) for at, heap in enumerate(self.best) for score, i in heap]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["item_id", "doc_id", "score"])


def walked(vectors: DataFrame, ids: list, terms: list[np.ndarray], weights: np.ndarray, floors: list[int], k: int) -> DataFrame:
    """The ``k`` best rows of each item in every task; at most ``k`` times the block's items each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(ids, terms, weights, floors, k)
        for batch in batches:
            for first in range(0, batch.num_rows, walk.rows):
                part = batch.slice(first, walk.rows)
                values = lambda c: [x.values.to_numpy() for x in part.column(c)]
                walk.visit(part.column(0).to_pylist(), part.column(1).to_numpy(), values(2), values(3))
        yield walk.result()

    return vectors.mapInArrow(run, RANKED)


def ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search_block(docs: DataFrame, block: list, k: int) -> DataFrame | None:
    """The results of one block of items, or None if no document has one of their terms."""
    words = sorted({t.encode() for row in block for t in row.terms})
    vocabulary = {word: at for at, word in enumerate(words)}
    rows = stored(counted(docs, vocabulary), "search-counts")
    totals = rows.agg(F.count("*").alias("documents"), F.sum("n").alias("length"), F.count_if(F.size("terms") > 0).alias("vectors")).first()
    if not totals.vectors:
        return None
    weights = np.zeros(len(words), np.int64)
    for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[r.term] = math.floor(1000 * math.log((2 * totals.documents + 2) / (2 * r["count"] + 1)))
    made = impact_vectors(rows, totals.documents, totals.length)
    # Copies share their length, so a hash of the id takes part in the ranges.
    order = [F.desc("norm"), F.xxhash64("doc_id")]
    vectors = stored(made.repartitionByRange(*order).sortWithinPartitions(*order), "search-vectors")

    ids = [row.item_id for row in block]
    terms = [np.array([vocabulary[t.encode()] for t in row.terms], np.int64) for row in block]
    least = vectors.agg(F.percentile_approx("norm", max(0.0, 1 - HEAD / totals.vectors), 10000)).first()[0]
    head = stored(ranked(walked(vectors.where(F.col("norm") >= least), ids, terms, weights, [0] * len(ids), k), k), "search-head")
    reached = {r.item_id: r.score for r in head.where(F.col("rank") == k).collect()}
    floors = [reached.get(i, 0) for i in ids]
    rest = walked(vectors.where(F.col("norm") < least), ids, terms, weights, floors, k)
    return ranked(head.drop("rank").unionByName(rest), k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents above 0 of every item."""
    asked = stored(item_terms(items).where(F.size("terms") > 0), "search-items")
    blocks = -(-asked.count() // ITEMS)
    place = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    parts = [search_block(docs, asked.where(place == at).collect(), k) for at in range(blocks)]
    parts = [p for p in parts if p is not None]
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)
