"""Bucketed tables whose hot keys are dealt over many buckets.

A bucket is one task, so a key that holds a third of the rows makes one task of a third of the table.  ``heavy_hitters`` finds such keys
in one pass with a mergeable frequent-items summary of bounded size.  ``write_dealt`` then buckets both tables of a join on the key and a
``deal`` number: rows of ordinary keys have deal 0; a hot key's rows in the larger table take turns through numbers that lie in different
buckets, and the smaller table repeats its rows of that key once for each.  The join on key and deal needs no shuffle, and no bucket holds much more than
another.

The summary may overstate a count but misses no key above its error, and what it says decides only where rows lie, never which
rows there are.  The smaller side is repeated, so joins are inner or keep the larger side.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

col = F.col
DEAL = "deal"
TRIES = 12   # numbers tried for each bucket, until every bucket has one with near certainty


def heavy_hitters(frame: DataFrame, key: str, at_most: int) -> DataFrame:
    """``item, count`` of up to ``at_most`` most frequent keys; counts are right to about a ``8 * at_most``-th of the rows."""
    top = frame.filter(col(key).isNotNull()).agg(F.expr(f"approx_top_k({key}, {at_most}, {8 * at_most})").alias("top"))
    return top.select(F.inline("top"))


def hot_deals(frame: DataFrame, key: str, buckets: int) -> dict[int, list[int]]:
    """For every key with at least half an average bucket of rows (fewer than ``2 * buckets`` keys): one deal number per bucket it is to fill.

    A key gets so many buckets that a piece of it is at most a quarter of an average bucket, or all.
    """
    rows = frame.count()
    found = heavy_hitters(frame, key, 2 * buckets).filter(col("count") * 2 * buckets >= rows)
    pieces = F.least(F.lit(buckets), F.ceil(col("count") * 4 * buckets / max(rows, 1)).cast("int"))
    tried = found.select(col("item").cast("bigint").alias("item"), pieces.alias("pieces"),
                         F.explode(F.sequence(F.lit(0), F.lit(TRIES * buckets - 1))).alias(DEAL))
    place = F.pmod(F.hash("item", DEAL), F.lit(buckets))
    firsts = tried.groupBy("item", "pieces", place.alias("bucket")).agg(F.min(DEAL).alias(DEAL))
    # Keys start at different buckets, so that several hot ones do not meet in the first.
    turn = F.pmod(col("bucket") + F.pmod(F.xxhash64("item"), F.lit(buckets)), F.lit(buckets))
    deals = firsts.groupBy("item", "pieces").agg(F.array_sort(F.collect_list(F.struct(turn.alias("turn"), DEAL))).alias("all"))
    return {r.item: [x[DEAL] for x in r["all"][: r.pieces]] for r in deals.collect()}


def _deals_of(key: str, deals: dict[int, list[int]]) -> Column:
    known = F.from_json(F.lit(json.dumps({str(k): v for k, v in deals.items()})), "map<string,array<int>>")
    return F.coalesce(F.try_element_at(known, col(key).cast("string")), F.array(F.lit(0)))


def dealt(frame: DataFrame, key: str, deals: dict[int, list[int]]) -> DataFrame:
    """The larger side: every row with its deal number, rows of a hot key in turns by a hash of the whole row."""
    numbers = _deals_of(key, deals)
    turn = F.pmod(F.xxhash64(*[c for c in frame.columns if c != key]), F.size(numbers)).cast("int")
    return frame.withColumn(DEAL, F.get(numbers, turn))


def repeated(frame: DataFrame, key: str, deals: dict[int, list[int]]) -> DataFrame:
    """The smaller side: a row for each deal number of its key."""
    return frame.withColumn(DEAL, F.explode(_deals_of(key, deals)))


def _write(frame: DataFrame, table: str, key: str, path: str, buckets: int) -> None:
    (frame.repartition(buckets, key, DEAL).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key, DEAL).sortBy(key, DEAL).saveAsTable(table))


def write_dealt(larger: DataFrame, smaller: DataFrame, keys: tuple[str, str], tables: tuple[str, str], paths: tuple[str, str],
                buckets: int) -> dict[int, list[int]]:
    """Write both tables alike; the deals of the hot keys."""
    deals = hot_deals(larger, keys[0], buckets)
    _write(dealt(larger, keys[0], deals), tables[0], keys[0], paths[0], buckets)
    _write(repeated(smaller, keys[1], deals), tables[1], keys[1], paths[1], buckets)
    return deals


def dealt_join(spark: SparkSession, tables: tuple[str, str], keys: tuple[str, str], how: str = "inner") -> DataFrame:
    """Rows of the larger table with those of the smaller one, bucket by bucket; ``how`` is inner or left."""
    if how not in ("inner", "left"):
        raise ValueError("the smaller side holds copies of hot keys, so only inner and left joins are right")
    larger = spark.table(tables[0])
    smaller = spark.table(tables[1]).withColumnRenamed(DEAL, "_deal")
    return larger.join(smaller, (col(keys[0]) == col(keys[1])) & (col(DEAL) == col("_deal")), how).drop(DEAL, "_deal")
