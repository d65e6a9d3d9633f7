import math
import random
import re
from collections import Counter, defaultdict

import pytest
from cases import EDGES, LONG, documents, edge_docs, no_docs

from tradewind.llm import search as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Every score of every document and item, by dictionaries."""
    rows = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    rows = [r for r in rows if r[2]]
    total, length = len(rows), sum(n for *_, n in rows)
    df = Counter(t for _, tf, _ in rows for t in tf)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(words(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc_id, tf, n in rows:
            m = 100 - 90 + (90 * n * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t in terms if t in tf)
            if score > 0:
                scores.append((-score, math.inf if doc_id is None else doc_id))
        for at, (score, doc_id) in enumerate(sorted(scores)[:k]):
            out.append((item, at + 1, None if doc_id == math.inf else doc_id, -score))
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_documents_equal_brute_force(spark, small):
    docs, items = documents(spark, small), documents(spark, small, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and got(S.search(docs, items)) == want


@pytest.mark.parametrize("head, bucket, focus, items_a_block", [(1, 1, 1, 1), (8, 3, 2, 5), (4096, 512, 8, 1024)])
def test_bounds_and_blocks_lose_nothing(spark, monkeypatch, head, bucket, focus, items_a_block):
    for name, value in (("HEAD", head), ("BUCKET", bucket), ("FOCUS", focus), ("ITEMS", items_a_block)):
        monkeypatch.setattr(S, name, value)
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda most: " ".join(draw.choices(vocabulary, [1 / (i + 1) for i in range(60)], k=draw.randint(0, most)))
    docs = [(i % 290 if i % 7 else None, text(40)) for i in range(300)] + [(1000 + i, "w3 w50 w50 w7") for i in range(40)]
    items = [(i, text(12)) for i in range(9)] + [(3, "w50 w51"), (None, "w3 W7"), (77, "nothing-like it"), (78, ""), (79, None)]
    monkeypatch.setattr(S, "CELLS", 200)
    assert got(S.search(*frames(spark, docs, items))) == brute(docs, items)


def test_pruned_buckets_are_not_scored(monkeypatch):
    import numpy as np
    scored = []
    monkeypatch.setattr(S.Walk, "keep", lambda self, at, alive, scores, order: scored.append(len(alive)))
    walk = S.Walk([1], [np.array([0, 1])], np.array([5, 7]), [10**6], 1)
    one = [np.array([0])]
    walk.visit([4], np.array([10.0]), one, [np.array([10])])
    assert not scored and not walk.cells.any()
    walk.visit([4, 5], np.array([10.0**6, 10.0**6]), [np.array([0]), np.array([1])], [np.array([10**6]), np.array([10**6])])
    assert scored == [2]


def test_edges(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, "Same WORDS ünïcode", "x"), (2, "lange text ein", "y"), (3, None, None), (4, "ß \x1c 😀", "z")],
                                  "item_id long, text string, score string")
    assert len(words(LONG)) == 45000
    assert got(S.search(docs, items)) == brute([(r[0], r[1]) for r in EDGES], [(1, "Same WORDS ünïcode"), (2, "lange text ein"), (4, "ß \x1c 😀")])
    assert S.search(no_docs(spark), items).count() == 0
    assert S.search(docs, items.where("false")).count() == 0
    assert S.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
