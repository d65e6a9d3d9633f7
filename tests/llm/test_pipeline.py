"""Each stage against brute force on its own input."""

import hashlib

import corpus_pipeline as P
from cases import EDGES, documents, edge_docs
from test_near_dedup import brute

from tradewind.llm import mixing, packing, toxicity


def test_stages(spark, small):
    docs = documents(spark, small)
    columns = docs.columns
    clean = P.without_toxic(spark, docs, small)
    assert clean.columns == columns
    scores = {r.doc_id: r.score for r in toxicity.toxicity(docs, documents(spark, small, "labels")).collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, s in scores.items() if s < 0.5}

    single = P.without_copies(spark, docs, small)
    best = {}
    for r in docs.collect():
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(best.values())

    apart = P.without_near_copies(spark, docs, small)
    kept = {d for d, _, root, _ in brute({r.doc_id: r.text for r in docs.collect()}, 5, 80) if root == d}
    assert apart.columns == columns and {r.doc_id for r in apart.collect()} == kept

    mixed = P.mixed(spark, docs, small)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(docs, P.MIX).collect() if r.copies}
    got = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == columns and {i: got.count(i) for i in set(got)} == copies and 0 < len(copies) < docs.count()

    pieces = P.packed(spark, docs, small)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_edges_pass_all_stages(spark, small):
    docs = edge_docs(spark)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), small).count() == 0
        if name == "exact_dedup":
            rows = [(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()]
            assert len(rows) == len(set(rows)) == len({r[1] or "" for r in EDGES})
    assert P.packed(spark, docs, small).count() >= len(EDGES)


def test_run(spark, small):
    rows = P.run(spark, small)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0
