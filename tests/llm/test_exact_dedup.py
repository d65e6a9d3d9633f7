import hashlib

import numpy as np
from cases import EDGES, edge_docs, no_docs
from pyspark.sql import functions as F

from tradewind.llm import exact_dedup as E


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, (5000, 4)).astype(np.uint64)
    sizes, bits, slots = E.build_shard(keys)
    assert sorted(slots) == list(range(5000))
    assert (E.find_slots(keys, sizes, bits) == slots).all()
    others = rng.integers(0, 1 << 63, (2000, 4)).astype(np.uint64)
    found = E.find_slots(others, sizes, bits)
    order = np.empty(5000, np.int64)
    order[slots] = np.arange(5000)
    hit = found >= 0
    assert not (keys[order][found[hit]] == others[hit]).all(axis=1).any()


def test_edges_equal_brute_force(spark):
    groups = {}
    for doc_id, text, *_ in EDGES:
        groups.setdefault(hashlib.sha256((text or "").encode()).hexdigest(), []).append(doc_id)
    want = []
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, digest) for i in ids]
    got = [tuple(r) for r in E.exact_dedup(edge_docs(spark)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert E.exact_dedup(no_docs(spark)).count() == 0


def test_history_wins_and_strangers_group_apart(spark):
    past = spark.createDataFrame([(100, "old"), (101, "older"), (102, "old")], "doc_id long, text string")
    now = spark.createDataFrame([(1, "old"), (2, "new"), (3, "new"), (4, "alone")], "doc_id long, text string")
    rows = {r.doc_id: r for r in E.exact_dedup(now, E.ledger(E.digests(past))).collect()}
    assert (rows[1].keep_id, rows[1].group_size, rows[1].kept) == (102, 3, False)
    assert (rows[2].keep_id, rows[3].keep_id, rows[3].kept, rows[2].kept, rows[2].group_size) == (3, 3, True, False, 2)
    assert rows[4].kept and rows[4].group_size == 1
    empty = E.ledger(E.digests(past.where(F.lit(False))))
    assert {r.doc_id for r in E.exact_dedup(now, empty).where("kept").collect()} == {1, 3, 4}


def test_several_shards(spark, monkeypatch):
    monkeypatch.setattr(E, "KEYS_PER_SHARD", 50)
    docs = spark.range(1000).selectExpr("id as doc_id", "cast(id % 400 as string) as text")
    rows = E.exact_dedup(docs).collect()
    assert len(rows) == 1000 and sum(r.kept for r in rows) == 400
    assert all(r.keep_id == max(i for i in range(1000) if i % 400 == r.doc_id % 400) for r in rows)


def test_minus_one_is_an_id_like_others(spark):
    past = spark.createDataFrame([(-1, "x"), (None, "y")], "doc_id long, text string")
    now = spark.createDataFrame([(5, "x"), (6, "y")], "doc_id long, text string")
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in E.exact_dedup(now, E.ledger(E.digests(past))).collect()}
    assert rows == {5: (-1, 2, False), 6: (6, 2, True)}


def test_deliveries_equal_one_batch(spark, monkeypatch):
    monkeypatch.setattr(E, "KEYS_PER_SHARD", 20)
    docs = spark.range(-50, 300).selectExpr("case when id % 41 = 0 then null else id end as doc_id", "cast(id % 77 as string) as text", "'x' as is_past")
    whole = sorted(map(str, E.exact_dedup(docs).collect()))
    for past in ("doc_id % 2 = 1", "doc_id > 100", "text < '3'", "true", "false"):
        assert sorted(map(str, E.dedup_deliveries(docs, F.expr(past)).collect())) == whole, past
    edges = edge_docs(spark)
    assert sorted(map(str, E.dedup_deliveries(edges, F.expr("doc_id < 6")).collect())) == sorted(map(str, E.exact_dedup(edges).collect()))
    assert E.dedup_deliveries(no_docs(spark), F.lit(True)).count() == 0
