"""Answers that follow the refresh sets instead of being computed anew.

Three questions are kept, one of each kind: sums (q01), counts per key with a histogram over them (q13), and a threshold with a
top hundred (q18).  Of each a state is stored: one partition from the tables as they were, and one for each set with what that set
changed.  A set's job looks only at orders that the set inserts or deletes: their rows before it (found by ranges of their keys, which reach the
scan, and a semi join) and after it.  Sums and counts keep the signed difference of the two; of the threshold question the touched
orders are added up again and take the place of what was known of them.  An answer reads the state alone, and the customers.

A set's partition is overwritten when its job runs again, so a repeated set counts once.  Sets are taken in the order of
their numbers, and a set has to be whole before its job runs.  ``fold`` adds the partitions of old sets up into one.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.refresh import KEYS, counting, merged
from tradewind.plans import queries as Q
from tradewind.session import scratch, stored
from tradewind.sources.tables import Catalog, listing

col, lit = F.col, F.lit
RANGES = 64
SUMS = {"quantity": "bigint", "price": "decimal(38,0)", "revenue": "decimal(38,0)", "charge": "decimal(38,0)", "discount": "bigint", "count_order": "bigint"}


@dataclass(frozen=True)
class Kept:
    """How a question is kept: ``change`` from the orders and lines before and after a set, ``total`` over all changes, ``answer`` from the total."""
    schema: str
    change: Callable[[Catalog | None, Catalog], DataFrame]
    total: Callable[[DataFrame], DataFrame]
    answer: Callable[[Catalog, DataFrame], DataFrame]


def _signed(measure: Callable[[Catalog], DataFrame], keys: list[str], sums: dict[str, str]) -> tuple[Callable, Callable]:
    """Change and total of a question whose measures add up."""

    def added(rows: DataFrame) -> DataFrame:
        whole = rows.groupBy(*keys).agg(*[F.sum(name).cast(kind).alias(name) for name, kind in sums.items()])
        return whole.filter(reduce(or_, [col(name) != 0 for name in sums]))

    def change(before: Catalog | None, after: Catalog) -> DataFrame:
        rows = measure(after)
        if before is not None:
            minus = measure(before).select(*keys, *[(-col(name)).alias(name) for name in sums])
            rows = rows.unionByName(minus)
        return added(rows)

    return change, added


def pricing_summary(days: int) -> Kept:
    change, total = _signed(lambda c: Q.pricing_sums(c.lineitem, days), ["l_returnflag", "l_linestatus"], SUMS)
    sums = ", ".join(f"{name} {kind}" for name, kind in SUMS.items())
    return Kept(f"l_returnflag string, l_linestatus string, {sums}", change, total, lambda c, rows: Q.pricing_report(rows))


def customer_distribution(first: str, second: str) -> Kept:
    change, total = _signed(lambda c: Q.counted_orders(c.orders, first, second), ["o_custkey"], {"n": "bigint"})
    return Kept("o_custkey bigint, n bigint", change, total, lambda c, counts: Q.histogram(Q.with_all_customers(c, counts)))


def large_orders(quantity: int) -> Kept:
    """The state holds large orders, and a row without a quantity for each large order that a set took away or made small.

    Of whole tables the large totals are stored first: their real size then decides whether the join has to move the orders.
    """
    columns = ["o_custkey", "o_orderdate", "o_totalprice", "q"]

    def change(before: Catalog | None, after: Catalog) -> DataFrame:
        large = Q.large_totals(after.lineitem, quantity)
        if before is None:
            return Q.large_orders(after.orders, stored(large, "kept-large"))
        now = Q.large_orders(after.orders, large)
        was = Q.large_orders(before.orders, Q.large_totals(before.lineitem, quantity)).select(col("o_orderkey").alias("_was"))
        joined = now.join(was, col("o_orderkey") == col("_was"), "full")
        return joined.select(F.coalesce("o_orderkey", "_was").alias("o_orderkey"), *columns)

    def total(changes: DataFrame) -> DataFrame:
        last = changes.groupBy("o_orderkey").agg(F.max_by(F.struct(*columns), "set").alias("row"))
        return last.select("o_orderkey", "row.*").filter(col("q").isNotNull())

    return Kept("o_orderkey bigint, o_custkey bigint, o_orderdate date, o_totalprice double, q bigint", change, total, Q.hundred_largest)


def _path(state: str, name: str) -> str:
    return os.path.join(state, name)


def _write(state: str, name: str, number: int, rows: DataFrame) -> None:
    (rows.withColumn("set", lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("set").parquet(_path(state, name)))


def _mark(spark: SparkSession, state: str, number: int) -> None:
    spark.createDataFrame([(number,)], "number int").coalesce(1).write.mode("overwrite").parquet(os.path.join(state, "applied", str(number)))


def applied(spark: SparkSession, state: str) -> int:
    """The last set that the state contains."""
    found = listing(spark, os.path.join(state, "applied"))
    return max((int(name) for name, *_ in found.entries if name.isdigit()), default=0) if found else 0


def begin(base: Catalog, state: str, kept: dict[str, Kept]) -> None:
    """The first partitions, from whole tables."""
    for name, one in kept.items():
        _write(state, name, 0, one.change(None, base))


def key_ranges(keys: DataFrame) -> list[tuple[int, int]]:
    """At most ``RANGES`` ranges that hold all ``key`` values, without the gaps between them."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return []
    width = (high - low) // RANGES + 1
    parts = keys.groupBy(F.expr(f"(key - {low}L) div {width}L").alias("part")).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    return [(r.low, r.high) for r in parts.orderBy("part").collect()]


def _in_ranges(key: str, ranges: list[tuple[int, int]]) -> Column:
    return reduce(or_, [col(key).between(low, high) for low, high in ranges])


def touched_keys(spark: SparkSession, store: str, number: int) -> DataFrame:
    """``key`` of the orders that one set inserts or deletes."""
    sets = [(counting(spark, store, "orders_inserts", number - 1, number), "o_orderkey"), (counting(spark, store, "deletes", number - 1, number), "key")]
    keys = [rows.select(col(key).alias("key")) for rows, key in sets if rows is not None]
    return stored(reduce(DataFrame.unionByName, keys).distinct(), "kept-keys")


def touched_rows(base: Catalog, store: str, after: int, upto: int, keys: DataFrame, ranges: list[tuple[int, int]]) -> Catalog:
    """Orders and lines of the given keys as they are once the sets behind ``after`` up to ``upto`` have come."""
    frames = {}
    for name, key in KEYS.items():
        rows = merged(getattr(base, name), store, name, after, upto).filter(_in_ranges(key, ranges))
        frames[name] = rows.join(keys, col(key) == col("key"), "left_semi")
    return base.with_tables(**frames)


def apply_set(base: Catalog, store: str, state: str, kept: dict[str, Kept], number: int, after: int = 0) -> None:
    """Store what one set changes; ``base`` contains the sets up to ``after``, the store those behind it."""
    keys = touched_keys(base.spark, store, number)
    ranges = key_ranges(keys)
    if ranges:
        before = touched_rows(base, store, after, number - 1, keys, ranges)
        then = touched_rows(base, store, after, number, keys, ranges)
        for name, one in kept.items():
            _write(state, name, number, one.change(before, then))
    _mark(base.spark, state, number)


def keep_up(base: Catalog, store: str, state: str, kept: dict[str, Kept], after: int = 0) -> list[int]:
    """Apply every stored set that the state does not contain, in order; their numbers."""
    found = {}
    for name in ("orders_inserts", "deletes"):
        entries = listing(base.spark, os.path.join(store, name))
        found |= {int(e.removeprefix("refresh=")): True for e, *_ in entries.entries if e.startswith("refresh=")} if entries else {}
    numbers = sorted(n for n in found if n > applied(base.spark, state))
    for number in numbers:
        apply_set(base, store, state, kept, number, after)
    return numbers


def changes(spark: SparkSession, state: str, name: str, kept: dict[str, Kept]) -> DataFrame:
    return spark.read.schema(f"{kept[name].schema}, set int").parquet(_path(state, name))


def answer(c: Catalog, state: str, name: str, kept: dict[str, Kept]) -> DataFrame:
    """The question's rows; nothing of orders and lines is read."""
    return kept[name].answer(c, kept[name].total(changes(c.spark, state, name, kept)))


def fold(spark: SparkSession, state: str, kept: dict[str, Kept]) -> str:
    """A new state folder with one partition in the place of all of this one's."""
    folded, number = scratch(spark, "kept"), applied(spark, state)
    for name, one in kept.items():
        _write(folded, name, number, one.total(changes(spark, state, name, kept)))
    _mark(spark, folded, number)
    return folded
