import re
from collections import Counter, defaultdict

import pytest
from cases import EDGES, documents, edge_docs, no_docs

from tradewind.llm import near_dedup as N

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, words, percent):
    """Set size and component of every document, from all pairs that share a shingle."""
    sets, holders = {}, defaultdict(list)
    for doc_id, text in texts.items():
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        size = min(words, len(found))
        sets[doc_id] = {tuple(found[i: i + size]) for i in range(len(found) - size + 1)} if found else set()
        for s in sets[doc_id]:
            holders[s].append(doc_id)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for other, common in Counter(o for x in s for o in holders[x] if o < d).items():
            if 100 * common >= percent * (len(s) + len(sets[other]) - common):
                a, b = root(d), root(other)
                parent[max(a, b)] = min(a, b)
    return {(d, len(s), root(d), root(d) == d) for d, s in sets.items()}


@pytest.mark.parametrize("words", [2, 5])
def test_documents_equal_brute_force(spark, small, words):
    docs = documents(spark, small)
    got = {tuple(r) for r in N.near_dedup(docs, words, 80).collect()}
    assert got == brute({r.doc_id: r.text for r in docs.collect()}, words, 80)


def test_edges(spark):
    got = N.near_dedup(edge_docs(spark), 2, 80).collect()
    named = {tuple(r) for r in got if r.doc_id is not None}
    assert named == brute({r[0]: r[1] for r in EDGES if r[0] is not None}, 2, 80)
    assert [tuple(r)[2:] for r in got if r.doc_id is None] == [(None, True)] * 2
    assert N.near_dedup(no_docs(spark)).count() == 0


def test_chains_and_groups_without_a_common_leader(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(n, " ".join(f"c{n}x{i}" if n * 6 <= i < n * 6 + 6 * (n > 0) or (i < 6 * n and i % 2) else w for i, w in enumerate(base)))
            for n in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in N.near_dedup(docs, 2, 80).collect()}
    assert got == brute(dict(rows), 2, 80)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in N.components(frame, "test-links").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def framed(pages, frame, own, buckets=1):
    """Members of shared buckets, each a component of its own, and their sets: a common frame and shingles of their own."""
    sets = [(p, sorted([*range(-frame, 0), *range(p * own, (p + 1) * own)])) for p in range(pages)]
    return [(b, p, frame + own, p) for p, _ in sets for b in range(buckets)], sets


def frames(spark, members, sets):
    return (spark.createDataFrame(members, "key long, rep long, n long, comp long"),
            spark.createDataFrame(sets, "id long, items array<long>"))


def test_pages_of_one_frame_need_no_pairs_and_no_blocks(spark):
    members, sets = frames(spark, *framed(20_000, 60, 30, 2))
    assert N.beginnings(members, sets, 80).count() == 0
    assert N.links_across(members, sets, 80).count() == 0


@pytest.mark.parametrize("rare", [0, 2, 64])
def test_links_within_mixed_buckets_equal_brute_force(spark, monkeypatch, rare):
    """Linked pairs among framed pages, through rare shingles, through common ones, and on the edge of the similarity."""
    monkeypatch.setattr(N, "RARE", rare)
    members, sets = framed(150, 40, 20)
    for p in range(0, 150, 3):  # every third page has a near copy; the number of changed shingles goes over the edge
        changed, copy = p % 13, 1000 + p
        items = sorted([*sets[p][1][changed:], *(10**6 + p * 20 + i for i in range(changed))])
        sets.append((copy, items))
        members.append((0 if p % 2 else 7, copy, len(items), copy))
        members.append((7, p, 60, p))
    held = dict(sets)
    by_key = defaultdict(set)
    for key, rep, _, _ in members:
        by_key[key].add(rep)
    want = set()
    for reps in by_key.values():
        for a in reps:
            for b in reps:
                common = len(set(held[a]) & set(held[b]))
                if a < b and 100 * common >= 80 * (len(held[a]) + len(held[b]) - common):
                    want.add((a, b))
    got = {tuple(r) for r in N.links_across(*frames(spark, members, sets), 80).collect()}
    assert got == want and 20 < len(want) < 50
