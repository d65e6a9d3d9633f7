"""Packing against the tokenizer itself."""

import numpy as np
import pytest
from cases import EDGES, documents, edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check(rows, texts, tokenizer):
    """Every id lies in one piece, windows are gapless and not overfull; returns the share of padding."""
    by_doc, windows = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        want = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 0], "<u4")
        pieces.sort(key=lambda r: r.start)
        assert b"".join(p.ids for p in pieces) == want.tobytes()
        assert [p.start for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces])[:-1])
        assert all(p.doc_tokens == len(want) and p.length == len(p.ids) // 4 for p in pieces)
    for pieces in windows.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces])[:-1])
        assert sum(p.length for p in pieces) <= packing.CAPACITY
    total = sum(r.length for r in rows)
    return 1 - total / max(1, packing.CAPACITY * len(windows))


def test_all_documents(spark, small, tokenizer):
    docs = documents(spark, small).coalesce(1)
    padding = check(packing.pack(docs).collect(), {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    assert padding < 0.02


def test_edges(spark, tokenizer):
    rows = [r for r in EDGES if r[0] is not None and r[0] != 7]
    docs = edge_docs(spark).where("doc_id is not null and doc_id <> 7")
    check(packing.pack(docs).collect(), {r[0]: r[1] or "" for r in rows}, tokenizer)
    assert packing.pack(edge_docs(spark)).count() >= len(EDGES)
    assert packing.pack(no_docs(spark)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 1'.!\n\té　\x0b s")), max_size=30))
def test_cached_parts_give_the_same_ids(text):
    encoder = packing.Encoder(packing.default_tokenizer())
    assert encoder.encode(text) == encoder.whole(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1024), min_size=1, max_size=80))
def test_differencing_respects_the_capacity(lengths):
    placed = packing.assign(lengths, 1024)
    assert len(placed) == len(lengths) and np.bincount(placed, weights=lengths).max() <= 1024
