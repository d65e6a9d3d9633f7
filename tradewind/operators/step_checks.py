"""Key checks of one loaded step against what was loaded before it.

A table grows by steps, and checking its keys anew after each would read all of it.  Here each step leaves a summary of its
primary keys: how many there are, the range of the leading column, and a Bloom filter in blocks of 256 bits, made by an aggregation (block, bitwise or).  A
new step is checked inside itself exactly; of the earlier steps only those whose range meets the new keys matter, of these only the
filter is read (12 bits a key), and only keys that some filter may hold are compared exactly, with the key columns of those steps alone.

For a reference the parents of the same step come first, since steps bring orders with their lines; what is left is looked up in
the filters of the parents' steps.  A key that no filter holds is an orphan for sure; for the others the parents' key columns decide.
So violations are exact: a filter never misses a key it was made of.

Defined cases: keys with a null are no keys: they are counted for the primary key and skipped for references; checking a step again
gives the same rows; a step that is loaded again replaces its summary.
"""

from __future__ import annotations

import os
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.warehouse import append_step
from tradewind.schema import TABLES, ForeignKey
from tradewind.session import stored
from tradewind.sources.tables import listing

col, lit = F.col, F.lit
BITS_PER_KEY, BLOCK_BITS, WORDS = 12, 256, 4
FILTER = "block bigint, w0 bigint, w1 bigint, w2 bigint, w3 bigint, step int"
RANGE = "keys bigint, blocks bigint, low bigint, high bigint, step int"


def _folder(folder: str, name: str, kind: str) -> str:
    return os.path.join(folder, "_keys", kind, name)


def _block(keys: list[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), blocks)


def _bits(keys: list[str]) -> list[Column]:
    """One bit in each word of a block."""
    other = F.xxhash64(*keys, lit(1))
    return [F.call_function("shiftleft", lit(1).cast("bigint"), F.shiftright(other, 6 * w).bitwiseAND(lit(63)).cast("int")) for w in range(WORDS)]


def step_rows(spark: SparkSession, folder: str, name: str, steps: list[int]) -> DataFrame:
    """The rows of some steps of a table; other steps' folders are not read."""
    return spark.read.parquet(os.path.join(folder, name)).filter(col("step").isin(steps))


def filled_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*keys).filter(reduce(and_, [col(k).isNotNull() for k in keys]))


def remember_keys(spark: SparkSession, folder: str, name: str, step: int) -> None:
    """Write the summary of a loaded step's primary keys."""
    keys = list(TABLES[name].primary_key)
    own = filled_keys(step_rows(spark, folder, name, [step]), keys)
    size = own.agg(F.count("*").alias("n"), F.min(keys[0]).cast("bigint").alias("low"), F.max(keys[0]).cast("bigint").alias("high")).first()
    blocks = max(1, -(-size.n * BITS_PER_KEY // BLOCK_BITS))
    made = own.select(_block(keys, lit(blocks)).alias("block"), *[b.alias(f"b{w}") for w, b in enumerate(_bits(keys))])
    words = made.groupBy("block").agg(*[F.bit_or(f"b{w}").alias(f"w{w}") for w in range(WORDS)])
    summary = spark.createDataFrame([(size.n, blocks, size.low, size.high)], "keys bigint, blocks bigint, low bigint, high bigint").coalesce(1)
    for kind, rows in (("filters", words), ("ranges", summary)):
        (rows.withColumn("step", lit(step)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("step").parquet(_folder(folder, name, kind)))


def earlier_steps(spark: SparkSession, folder: str, name: str, before: int, low: int, high: int) -> dict[int, int]:
    """Blocks of the filters of earlier steps whose keys may lie within a range; one row a step is read."""
    path = _folder(folder, name, "ranges")
    if listing(spark, path) is None:
        return {}
    rows = spark.read.schema(RANGE).parquet(path).filter((col("step") < before) & (col("low") <= high) & (col("high") >= low))
    return {r.step: r.blocks for r in rows.collect()}


def held_by_filters(spark: SparkSession, folder: str, name: str, rows: DataFrame, keys: list[str], steps: dict[int, int]) -> DataFrame:
    """The rows whose key some filter of the named steps may hold, once each."""
    filters = spark.read.schema(FILTER).parquet(_folder(folder, name, "filters")).filter(col("step").isin(list(steps)))
    pairs = F.array(*[F.struct(lit(s).alias("s"), lit(n).cast("bigint").alias("n")) for s, n in steps.items()])
    asked = rows.withColumn("_in", F.explode(pairs)).withColumn("_block", _block(keys, col("_in.n")))
    met = asked.join(filters, (col("_in.s") == col("step")) & (col("_block") == col("block")))
    has_all = reduce(and_, [col(f"w{w}").bitwiseAND(bit) == bit for w, bit in enumerate(_bits(keys))])
    return met.filter(has_all).select(rows.columns).distinct()


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(and_, [col(a) == col(b) for a, b in zip(left, right)])


def _range(rows: DataFrame, key: str) -> tuple[int, int] | None:
    low, high = rows.agg(F.min(key).cast("bigint"), F.max(key).cast("bigint")).first()
    return None if low is None else (low, high)


def known_before(spark: SparkSession, folder: str, name: str, rows: DataFrame, keys: list[str], step: int) -> DataFrame | None:
    """Of the rows (one for each key), those whose key an earlier step of the table has; None if no step comes into question."""
    own = list(TABLES[name].primary_key)
    limits = _range(rows, keys[0])
    steps = earlier_steps(spark, folder, name, step, *limits) if limits else {}
    if not steps:
        return None
    maybe = stored(held_by_filters(spark, folder, name, rows, keys, steps), "keys-maybe")
    there = step_rows(spark, folder, name, list(steps)).select(*[col(k).alias(f"_{k}") for k in own])
    return maybe.join(there, _same(keys, [f"_{k}" for k in own]), "left_semi")


def check_primary(spark: SparkSession, folder: str, name: str, step: int) -> DataFrame:
    """One row: distinct keys of the step, rows with a null in the key, keys repeated inside the step, keys that came before."""
    keys = list(TABLES[name].primary_key)
    rows = step_rows(spark, folder, name, [step]).select(*keys)
    holed = reduce(or_, [col(k).isNull() for k in keys])
    counts = stored(rows.filter(~holed).groupBy(*keys).agg(F.count("*").alias("n")), "keys-counts")
    before = known_before(spark, folder, name, counts.select(*keys), keys, step)
    parts = [counts.select(F.count("*").alias("keys"), F.count_if(col("n") > 1).alias("repeated_inside")).first(),
             rows.filter(holed).count(), 0 if before is None else before.count()]
    return spark.createDataFrame([("primary key", name, parts[0]['keys'], parts[1], parts[0].repeated_inside, parts[2])], PRIMARY)


PRIMARY = "check_name string, object_name string, keys bigint, null_rows bigint, repeated_inside bigint, repeated_before bigint"
FOREIGN = "check_name string, object_name string, keys bigint, orphan_keys bigint, orphan_rows bigint"


def orphans(spark: SparkSession, folder: str, name: str, fk: ForeignKey, step: int) -> tuple[int, DataFrame]:
    """Number of distinct references of the step, and those without a parent in this step or an earlier one, with their rows as ``n``."""
    keys, parents = list(fk.columns), list(fk.parent_columns)
    counts = stored(filled_keys(step_rows(spark, folder, name, [step]), keys).groupBy(*keys).agg(F.count("*").alias("n")), "keys-children")
    found = listing(spark, os.path.join(folder, fk.parent))
    left = counts
    if found and any(entry == f"step={step}" for entry, *_ in found.entries):
        own = step_rows(spark, folder, fk.parent, [step]).select(*[col(k).alias(f"_{k}") for k in parents])
        left = stored(counts.join(own, _same(keys, [f"_{k}" for k in parents]), "left_anti"), "keys-left")
    before = known_before(spark, folder, fk.parent, left.select(*keys), keys, step)
    if before is not None:
        there = before.select(*[col(k).alias(f"_{k}") for k in keys])
        left = left.join(there, _same(keys, [f"_{k}" for k in keys]), "left_anti")
    return counts.count(), left


def check_foreign(spark: SparkSession, folder: str, name: str, step: int) -> DataFrame:
    """One row for each reference of the table."""
    rows = []
    for fk in TABLES[name].foreign_keys:
        keys, left = orphans(spark, folder, name, fk, step)
        sums = left.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), lit(0)).alias("rows")).first()
        rows.append(("foreign key", fk.name, keys, sums['keys'], sums['rows']))
    return spark.createDataFrame(rows, FOREIGN)


def append_remembered(frame: DataFrame, folder: str, name: str, step: int) -> None:
    """Add one step of a table with the summary of its keys."""
    append_step(frame, folder, name, step)
    remember_keys(frame.sparkSession, folder, name, step)
