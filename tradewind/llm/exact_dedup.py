"""Exact deduplication by minimal perfect hashing over the distinct digests of the past.

The history is split into shards by hash.  Each shard holds a minimal perfect hash function (bit arrays
by level: keys that meet no other key at a level get a bit there, the others go to the next level; the
slot is the rank of the bit) and, by slot, the full 32-byte digest and the winner's locator.  A lookup
computes the slot and compares all bytes of the digest stored there, so a foreign digest is never
taken for a member.  Lookups run once per distinct digest of the batch, after pre-aggregation; a group of
copies of any size is one key.  Members follow the historical winner, the others are grouped among
themselves.

Defined cases: a null text counts as empty; rows that repeat a ``doc_id`` count as rows of their group and
are kept or dropped together; a null ``doc_id`` stays only in a group without any id; an empty batch
gives an empty result, an empty history an index without shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import stored, texts

KEYS_PER_SHARD = 1 << 14
SPREAD = 1.5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INDEX = "shard long, sizes array<int>, bits array<binary>, digests binary, winners binary, nameless binary, members binary"
FOUND = "digest binary, winner long, members long"


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row per document: id and SHA-256 of the unchanged UTF-8 text."""
    return texts(docs).select("doc_id", F.unhex(F.sha2(F.col("text"), 256)).alias("digest"))


def ledger(rows: DataFrame) -> DataFrame:
    """Distinct digests with the largest id and the number of rows."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count("*").alias("members"))


def _positions(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of every key in the bit array of a level; keys are rows of four 64-bit words."""
    mixed = keys[:, level % 4] ^ (keys[:, (level // 4 + 1) % 4] + np.uint64(level)) * _MULTIPLIER
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(size)).astype(np.int64)


def build_shard(keys: np.ndarray) -> tuple[list[int], list[bytes], np.ndarray]:
    """Sizes and packed bits of the levels, and the slot of each of the distinct keys."""
    sizes, bits, slots = [], [], np.full(len(keys), -1, np.int64)
    left, level, before = np.arange(len(keys)), 0, 0
    while len(left):
        size = int(len(left) * SPREAD) + 1
        place = _positions(keys[left], level, size)
        alone = np.bincount(place, minlength=size) == 1
        rank = before + np.cumsum(alone) - 1
        single = alone[place]
        slots[left[single]] = rank[place[single]]
        before += int(alone.sum())
        sizes.append(size)
        bits.append(np.packbits(alone).tobytes())
        left, level = left[~single], level + 1
    return sizes, bits, slots


def find_slots(keys: np.ndarray, sizes: list[int], bits: list[bytes]) -> np.ndarray:
    """Slot of every key, -1 where no level has its bit; a slot says nothing before its digest is compared."""
    slots, left, before = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, (size, packed) in enumerate(zip(sizes, bits)):
        alone = np.unpackbits(np.frombuffer(packed, np.uint8), count=size).astype(bool)
        place = _positions(keys[left], level, size)
        hit = alone[place]
        slots[left[hit]] = (before + np.cumsum(alone) - 1)[place[hit]]
        before, left = before + int(alone.sum()), left[~hit]
    return slots


def _words(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 4)


def _index_shard(group: pa.Table) -> pa.Table:
    keys = _words(group["digest"])
    sizes, bits, slots = build_shard(keys)
    order = np.empty(len(keys), np.int64)
    order[slots] = np.arange(len(keys))
    number = lambda name: group[name].to_numpy()[order].astype("<i8").tobytes()
    ids = group["winner"].combine_chunks()
    winners = ids.fill_null(0).to_numpy()[order].astype("<i8").tobytes()
    nameless = ids.is_null().to_numpy(zero_copy_only=False)[order].tobytes()
    return pa.table({
        "shard": pa.array([group["shard"][0].as_py()], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int32())),
        "bits": pa.array([bits], pa.list_(pa.binary())), "digests": pa.array([keys[order].tobytes()], pa.binary()),
        "winners": pa.array([winners], pa.binary()), "nameless": pa.array([nameless], pa.binary()), "members": pa.array([number("members")], pa.binary())})


def _look_up(batch: pa.Table, index: pa.Table) -> pa.Table:
    wanted = batch["digest"].combine_chunks() if batch.num_rows else pa.array([], pa.binary())
    winners, members = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
    found, named = np.zeros(len(wanted), bool), np.zeros(len(wanted), bool)
    if len(wanted) and index.num_rows:
        row = index.to_pylist()[0]
        keys, stored_keys = _words(wanted), np.frombuffer(row["digests"], "<u8").reshape(-1, 4)
        slots = find_slots(keys, row["sizes"], row["bits"])
        found = (slots >= 0) & (stored_keys[slots] == keys).all(axis=1)
        winners = np.where(found, np.frombuffer(row["winners"], "<i8")[slots], 0)
        named = found & (np.frombuffer(row["nameless"], np.uint8)[slots] == 0)
        members = np.where(found, np.frombuffer(row["members"], "<i8")[slots], 0)
    return pa.table({"digest": wanted, "winner": pa.array(winners, mask=~named), "members": pa.array(members, mask=~found)})


def _sharded(rows: DataFrame, shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("long"))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard of a ledger: levels, digests and locators by slot."""
    return _sharded(history, shards).groupBy("shard").applyInArrow(_index_shard, INDEX)


def look_up(distinct: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Winner and size of every distinct digest that the index holds, nulls for the others."""
    batch = _sharded(distinct.select("digest"), shards)
    return batch.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_look_up, FOUND)


def shard_count(keys: int) -> int:
    return max(1, -(-keys // KEYS_PER_SHARD))


def exact_dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    ``history`` is a ledger (``digest, winner, members``) of what was seen before; without one, the ledger
    of ``docs`` itself is the history, so of equal texts the largest id stays.  With one, rows whose digest it
    holds follow its winner and add to its size, and the rest are grouped by themselves.
    """
    rows = stored(digests(docs), "exact-digests")
    batch = stored(ledger(rows), "exact-ledger")
    past = batch if history is None else history.select("digest", "winner", "members")
    shards = shard_count(max(past.count(), batch.count()))
    index = stored(build_index(past, shards), "exact-index")
    found = look_up(batch, index, shards).select("digest", F.col("winner").alias("old"), F.col("members").alias("had"))
    groups = found.join(batch, "digest")
    if history is None:
        size = F.col("had")
    else:
        size = F.coalesce(F.col("had"), F.lit(0)) + F.col("members")
    groups = groups.select(
        F.col("digest").alias("group"), size.alias("group_size"),
        F.coalesce("old", "winner").alias("keep_id"))
    return with_groups(rows, groups)


def with_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, F.col("digest") == F.col("group")).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def dedup_deliveries(docs: DataFrame, is_past: Column) -> DataFrame:
    """The rows of ``exact_dedup(docs)``, with the rows of an earlier delivery as the indexed history.

    Digests of the later rows are looked up: members join their historical group, whose winner becomes the largest id of both,
    nonmembers are groups of their own, and historical digests that do not come again stay what they are.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(is_past, F.lit(False)).alias("is_past"))
    known = stored(digests(rows.where("is_past")), "exact-past")
    fresh = stored(digests(rows.where("not is_past")), "exact-fresh")
    past, batch = stored(ledger(known), "exact-history"), stored(ledger(fresh), "exact-ledger")
    shards = shard_count(max(past.count(), batch.count()))
    found = look_up(batch, stored(build_index(past, shards), "exact-index"), shards)
    met = found.select("digest", F.col("winner").alias("old"), F.col("members").alias("had")).join(batch, "digest")
    came = stored(met.select(F.col("digest").alias("group"), (F.coalesce("had", F.lit(0)) + F.col("members")).alias("group_size"),
                             F.greatest("old", "winner").alias("keep_id")), "exact-came")
    stayed = past.join(came, F.col("digest") == F.col("group"), "left_anti").select(
        F.col("digest").alias("group"), F.col("members").alias("group_size"), F.col("winner").alias("keep_id"))
    return with_groups(known.unionByName(fresh), came.unionByName(stayed))
