"""Near-duplicate groups by circulant MinHash, banding and exact verification.

Two permutations make the whole signature: the first places a shingle on a circle of 2^32 points, the second, a
bijection of that circle, orders the points; coordinate k is the least value of the second permutation over
the document's places shifted by k.  Documents that share a band of ``ROWS`` coordinates are candidates; a pair at a
similarity of 0.8 shares none of the ``BANDS`` bands with a probability of 3 in a million, and so does no
more than one in a thousand of pairs at 0.9 times that.  A link is decided on the full shingle sets.

Equal shingle sets are one class with the smallest id as its representative, so copies cost one row each.  In a
bucket of candidates nobody is paired with everybody: every member is verified against two leaders, linked
members are contracted into components, and only buckets whose members still lie in several components go on.
Their members meet again where they share a rare shingle at the beginning of their sets, in an order from rare to common
(an exact prefix filter); only members whose beginnings reach common shingles are compared block by block.  So no
link between candidates is lost, and pages that share a frame but less than the asked similarity cost one row for each
shingle.  Components come from repeated star contraction of the links.

Defined cases: a text that is null, empty or blank has no shingle and links with nothing; with fewer words than
a shingle takes, the whole sequence is the one shingle; rows that repeat a ``doc_id`` count as one document
(of differing texts the one whose set has the smaller digest); a row without ``doc_id`` stays as it is; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import LOWER, by_batch, stored, texts

BANDS, ROWS = 32, 5
CACHED_WORDS = 300_000
BLOCK, CHUNK = 512, 1024
RARE = 64  # a shingle in more sets than this pairs nobody; its holders are compared in blocks
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
SIGNED = "doc_id long, n_shingles long, set_key binary, bands array<long>"


class Words(dict):
    """Bounded cache of 64-bit word hashes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str, words: int, cache: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    found = text.encode().translate(LOWER).split()
    h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    size = min(words, len(h))
    mixed = np.full(len(h) - size + 1, size, np.uint64)
    for at in range(size):
        mixed = (mixed ^ h[at: len(h) - size + 1 + at]) * _ODD[0]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed * _ODD[1])


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """All coordinates from one placing of the shingles and the circular shifts of one order of the places."""
    placed = ((hashes ^ (hashes >> np.uint64(33))) * _ODD[1] >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    step = 256
    for at in range(0, len(placed), step):
        x = shifts + placed[None, at: at + step]
        for shift, odd in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            x ^= x >> np.uint32(shift)
            x *= np.uint32(odd)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[0]
    for at in range(ROWS):
        key = (key ^ rows[:, at]) * _ODD[1]
        key ^= key >> np.uint64(31)
    return key.astype(np.int64)


def sign(docs: DataFrame, words: int) -> DataFrame:
    """Set size, digest of the set and band keys of every row."""

    def work(batch: pa.RecordBatch, cache: Words) -> pa.RecordBatch:
        sizes, keys, bands = [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text, words, cache)
            sizes.append(len(found))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            bands.append(band_keys(signature(found, BANDS * ROWS)) if len(found) else np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set_key", "bands"])

    return by_batch(texts(docs), SIGNED, work, Words)


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``id, items`` of the documents whose id and set digest are wanted."""

    def work(batch: pa.RecordBatch, cache: Words) -> pa.RecordBatch:
        found = [shingles(t, words, cache) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2),
             pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in found], pa.binary()),
             pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], names=["id", "wanted", "own", "items"])

    rows = texts(docs).join(wanted, F.col("doc_id") == F.col("rep")).select("doc_id", "text", "set_key")
    made = by_batch(rows.dropDuplicates(["doc_id", "text"]), "id long, wanted binary, own binary, items array<long>", work, Words)
    return made.where("wanted = own").select("id", "items")


def size_allows(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` whose documents' full sets reach the similarity."""
    first = sets.select(F.col("id").alias("a"), F.col("items").alias("of_a"))
    second = sets.select(F.col("id").alias("b"), F.col("items").alias("of_b"))
    both = pairs.join(second, "b").join(first, "a")
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.size("of_a").cast("long") + F.size("of_b") - common
    return both.where(common * 100 >= union * percent).select(pairs.columns)


def components(links: DataFrame, label: str) -> DataFrame:
    """``node, root`` for every end of a link; the root is the smallest node of its component.

    Each round hangs the larger neighbours of a node, then the smaller ones with the node, on the smallest of
    them, until every node hangs on one that hangs on none.  The smallest neighbours are written before the joins
    with them, so that both sides of a join are rows as stored and a node with very many links can be split or broadcast against.
    """
    down = lambda e: e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(down(links), label)
    while not _is_settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("low")).select("at", F.least("at", "low").alias("low"))
        least = stored(least, label)
        large = both.join(least, F.col("u") == F.col("at")).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = stored(large, label)
        least = stored(large.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("low")), label)
        small = large.join(least, F.col("u") == F.col("at")).select(F.col("v").alias("a"), F.col("low").alias("b"))
        edges = stored(down(small.unionByName(least.select(F.col("at").alias("a"), F.col("low").alias("b")))), label)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none."""
    ends = edges.select("u", F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    both = ends.groupBy("u").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return both.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()


def links_across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links ``a, b`` between components whose members share a bucket.

    The first shingle that two linked sets have in common stands at the beginning of both.  Where it is rare, the
    two meet as a pair; where it is common, both beginnings reach common shingles, and both go to the blocks.
    """
    shares = members.groupBy(F.col("key").alias("at"), "comp").agg(F.count("*").alias("size"))
    mixed = shares.groupBy("at").agg(F.count("*").alias("comps")).where("comps > 1").select("at")
    rows = stored(members.join(mixed, F.col("key") == F.col("at")).drop("at"), "near-members")
    begun = stored(beginnings(rows, sets, percent), "near-beginnings")
    pairs = stored(pairs_of(begun, percent), "near-pairs")
    close = verified(pairs, sets, percent).select(F.least("comp_a", "comp_b").alias("a"), F.greatest("comp_a", "comp_b").alias("b"))
    crowded = begun.where("crowded").select(F.col("rep").alias("at"))
    left = rows.join(crowded, F.col("rep") == F.col("at"), "left_semi")
    return close.distinct().unionByName(links_in_blocks(left, sets, percent))


def beginnings(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``rep, n, comp, buckets, alone, rare, crowded`` of every member that can have a link.

    Shingles are ordered by the number of sets that hold them, then by value.  A set's beginning has n - least common + 1
    of them: ``alone`` that no other set holds, then ``rare`` ones; it is ``crowded`` if it goes on from there.
    """
    members = rows.groupBy("rep").agg(F.first("n").alias("n"), F.first("comp").alias("comp"), F.collect_set("key").alias("buckets"))
    items = members.select("rep").join(sets, F.col("rep") == F.col("id")).select("rep", F.explode("items").alias("item"))
    holders = items.groupBy(F.col("item").alias("at")).agg(F.count("*").alias("held")).where(F.col("held") <= RARE)
    known = items.join(holders, F.col("item") == F.col("at")).groupBy(F.col("rep").alias("at")).agg(
        F.count_if(F.col("held") == 1).alias("alone"),
        F.array_sort(F.collect_list(F.when(F.col("held") > 1, F.struct("held", "item")))).alias("rare"))
    begin = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    all_ = members.join(known, F.col("rep") == F.col("at"), "left").withColumn("alone", F.coalesce("alone", F.lit(0))).where(
        F.col("alone") < begin)
    rare = F.coalesce(F.slice("rare", F.lit(1), (begin - F.col("alone")).cast("int")), F.array())
    return all_.select("rep", "n", "comp", "buckets", "alone", F.transform(rare, lambda x: x["item"]).alias("rare"),
                       (F.col("alone") + F.size(rare) < begin).alias("crowded"))


def pairs_of(begun: DataFrame, percent: int) -> DataFrame:
    """``a, b, comp_a, comp_b``: members of different components that share a bucket and a rare shingle of their beginnings.

    What can still be in common from that shingle on has to reach the similarity.
    """
    at = begun.select("rep", "n", "comp", "buckets", "alone", F.posexplode("rare").alias("place", "item"))
    side = lambda x: at.select("item", F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("comp").alias(f"comp_{x}"),
                               F.col("buckets").alias(f"in_{x}"), (F.col("n") - F.col("alone") - F.col("place")).alias(f"left_{x}"))
    met = side("a").join(side("b"), "item").where("a < b and comp_a <> comp_b").where(size_allows("n_a", "n_b", percent))
    enough = F.least("left_a", "left_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    return met.where(enough & F.arrays_overlap("in_a", "in_b")).select("a", "b", "comp_a", "comp_b").distinct()


def links_in_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links ``a, b`` between components whose members share a bucket, without a row for any pair.

    In a bucket of several components the members outside the largest one are compared with all others.  The
    bucket is dealt out in blocks of bounded size, which those members visit in chunks of bounded size;
    inside a block an index of its shingles counts what they have in common, so no pair becomes a row.
    """
    shares = members.groupBy(F.col("key").alias("at"), "comp").agg(F.count("*").alias("size"))
    mixed = shares.groupBy("at").agg(F.max_by("comp", "size").alias("main"), F.sum("size").alias("all"), F.max("size").alias("most"))
    parts = lambda rows, size: F.ceil(rows / F.lit(size)).cast("int")
    mixed = mixed.where("all > most").select("at", "main", parts(F.col("all"), BLOCK).alias("blocks"),
                                             parts(F.col("all") - F.col("most"), CHUNK).alias("chunks"))
    rows = stored(members.join(mixed, F.col("key") == F.col("at")).drop("at"), "near-members")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    held = rows.select("key", F.pmod(F.xxhash64("rep"), "blocks").cast("int").alias("block"), spread(F.col("chunks")).alias("chunk"),
                       F.lit(False).alias("asks"), "rep", "comp")
    asking = rows.where("comp <> main").select(
        "key", spread(F.col("blocks")).alias("block"), F.pmod(F.xxhash64("rep", F.lit(7)), "chunks").cast("int").alias("chunk"),
        F.lit(True).alias("asks"), "rep", "comp")
    dealt = held.unionByName(asking).join(sets, F.col("rep") == F.col("id")).select("key", "block", "chunk", "asks", "comp", "items")
    sorted_ = dealt.repartition("key", "block", "chunk").sortWithinPartitions("key", "block", "chunk", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held_sets, asking_sets = None, [], []
        found: set[tuple[int, int]] = set()
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(3)]))
            asks, comps, items = batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5)
            offsets, values = items.offsets.to_numpy(), items.values.to_numpy()
            for at, key in enumerate(keys):
                if key != place:
                    found |= compare(held_sets, asking_sets, percent)
                    place, held_sets, asking_sets = key, [], []
                (asking_sets if asks[at] else held_sets).append((comps[at], values[offsets[at]: offsets[at + 1]].copy()))
            yield _pairs(found)
            found = set()
        yield _pairs(compare(held_sets, asking_sets, percent))

    return sorted_.mapInArrow(run, "a long, b long").distinct()


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*sorted(found)) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def compare(held: list, asking: list, percent: int) -> set[tuple[int, int]]:
    """Pairs of components with a link between a held and an asking set; sets are (component, sorted items)."""
    if not held or not asking:
        return set()
    sizes = np.array([len(x) for _, x in held])
    comps = np.array([c for c, _ in held])
    items = np.concatenate([x for _, x in held])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], np.repeat(np.arange(len(held)), sizes)[order]
    found = set()
    for comp, wanted in asking:
        low, high = np.searchsorted(items, wanted, "left"), np.searchsorted(items, wanted, "right")
        counts = high - low
        hits = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        common = np.bincount(owner[hits], minlength=len(held))
        linked = (100 * common >= percent * (sizes + len(wanted) - common)) & (comps != comp)
        found |= {(min(comp, int(c)), max(comp, int(c))) for c in set(comps[linked])}
    return found


def near_groups(signed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, root`` over representatives that have a link."""
    reps = stored(signed.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "near-reps")
    buckets = reps.select(F.explode("bands").alias("key"), "rep", "n", "set_key")
    # Two leaders for each bucket: the smallest id, and the smallest hash of an id, which is another one in most buckets.
    leads = buckets.groupBy(F.col("key").alias("at")).agg(
        F.count("*").alias("size"), F.min(F.struct("rep", "n")).alias("low"),
        F.min(F.struct(F.xxhash64("rep", F.lit(1)).alias("order"), "rep", "n")).alias("any")).where("size > 1").select(
            "at", F.array(F.struct("low.rep", "low.n"), F.struct("any.rep", "any.n")).alias("leads"))
    members = stored(buckets.join(leads, F.col("key") == F.col("at")).drop("at"), "near-members")
    wanted = members.groupBy("rep").agg(F.first("set_key").alias("set_key"))
    sets = stored(shingle_sets(docs, wanted, words), "near-sets")

    led = members.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.explode("leads").alias("lead"))
    pairs = led.where((F.col("b") != F.col("lead.rep")) & size_allows("n_b", "lead.n", percent)).select(
        F.col("lead.rep").alias("a"), "b").distinct()
    roots = components(verified(stored(pairs, "near-pairs"), sets, percent), "near-links")

    named = stored(members.select("key", "rep", "n").join(roots, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "n", F.coalesce("root", "rep").alias("comp")), "near-members")
    more = stored(links_across(named, sets, percent), "near-links")
    if more.isEmpty():
        return roots
    return components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), "near-links")


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    rows = stored(sign(docs, words), "near-signed")
    signed = rows.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct("set_key", "n_shingles", "bands")).alias("s")).select("doc_id", "s.*")
    signed = stored(signed, "near-documents")
    roots = near_groups(signed, docs, words, percent)
    classes = signed.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = classes.join(roots, F.col("rep") == F.col("node"), "left").select(
        F.col("set_key").alias("class"), F.coalesce("root", "rep").alias("component"))
    known = signed.join(classes, F.col("set_key") == F.col("class"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    nameless = rows.where("doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return known.unionByName(nameless).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
