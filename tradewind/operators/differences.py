"""Where two loads of a table differ, found by a tree of digests over key ranges.

A checksum of a table says that something differs, not where.  Here a leaf holds the digest of the rows in a range of ``2^LEAF_BITS`` keys: their number and two sums of
hash halves, so the order of rows does not matter.  Each level above adds up ``2^FAN_BITS`` nodes, up to one root.  Trees are
stored, so two loads are compared without their rows: from the root down, only the children of nodes that differ are read.  Then the
rows of the differing leaves alone are compared.

Money counts in cents and dates as ISO text, as in the table checksum; null and text are told apart.  Rows without a key have a leaf of their own.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.money import cents
from tradewind.schema import TABLES
from tradewind.session import stored

col, lit = F.col, F.lit
LEAF_BITS, FAN_BITS = 10, 4
NAMED = 1000   # differing nodes up to this number are named in the filter of the scan; more are joined
NODE = "node bigint, rows bigint, high decimal(38,0), low decimal(38,0)"
DIGEST = ("rows", "high", "low")


def row_hash(name: str) -> Column:
    """64 bits of all declared columns of a row."""
    table = TABLES[name]
    text = [F.expr(cents(c.name)).cast("string") if c.name in table.money else col(c.name).cast("string") for c in table.columns]
    return F.xxhash64(*[F.coalesce(F.concat(lit("="), t), lit("~")) for t in text])


def leaf_of(name: str) -> Column:
    return F.shiftright(col(TABLES[name].primary_key[0]).cast("bigint"), LEAF_BITS)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("node").agg(*[F.sum(c).cast("bigint" if c == "rows" else "decimal(38,0)").alias(c) for c in DIGEST])


def build_tree(frame: DataFrame, name: str, folder: str) -> int:
    """Store the levels of a table's tree; the number of the root's level.  The rows are read once."""
    code = row_hash(name)
    leaves = frame.select(leaf_of(name).alias("node"), lit(1).alias("rows"), F.shiftright(code, 32).alias("high"),
                          code.bitwiseAND(lit(0xFFFFFFFF)).alias("low"))
    level, nodes = 0, _summed(leaves)
    while True:
        path = os.path.join(folder, str(level))
        nodes.repartitionByRange("node").sortWithinPartitions("node").write.mode("overwrite").parquet(path)
        nodes = frame.sparkSession.read.schema(NODE).parquet(path)
        low, high, some = nodes.agg(F.min("node"), F.max("node"), F.count_if(col("node").isNull())).first()
        if low is None or (low == high and not some):
            return level
        if (low, high) in ((-1, 0), (0, 0), (-1, -1)):   # signs do not meet by shifting: one more level for all
            nodes = _summed(nodes.withColumn("node", lit(0).cast("bigint")))
        else:
            nodes = _summed(nodes.withColumn("node", F.shiftright("node", FAN_BITS)))
        level += 1


@dataclass
class Found:
    """Differing leaves, and how many nodes were read on the way to them."""
    leaves: DataFrame
    nodes_read: int


def differing_leaves(spark: SparkSession, first: str, second: str, levels: tuple[int, int]) -> Found:
    """``node`` of every leaf whose digest is not the same in both trees."""
    read = lambda folder, level: spark.read.schema(NODE).parquet(os.path.join(folder, str(level)))
    top, open_, count = min(levels), None, 0
    for level in range(top, -1, -1):
        a, b = (read(folder, level) for folder in (first, second))
        if open_ is not None:
            named = [r.node for r in open_.limit(NAMED + 1).collect()]
            a, b = _children(a, open_, named), _children(b, open_, named)
        both = stored(a.select(col("node"), *[col(c).alias(f"a_{c}") for c in DIGEST]).join(
            b.select(col("node").alias("_node"), *[col(c).alias(f"b_{c}") for c in DIGEST]), col("node").eqNullSafe(col("_node")), "full"), "differences")
        count += both.count()
        unlike = reduce(or_, [~col(f"a_{c}").eqNullSafe(col(f"b_{c}")) for c in DIGEST])
        open_ = both.filter(unlike).select(F.coalesce("node", "_node").alias("node"))
    return Found(open_, count)


def _children(nodes: DataFrame, parents: DataFrame, named: list[int | None]) -> DataFrame:
    """The nodes below differing ones; a few are named as ranges, which reach the scan.

    Nodes of different signs and of rows without a key meet in the root only, which is always named.
    """
    if len(named) > NAMED:
        of = parents.select(col("node").alias("_parent"))
        return nodes.join(of, F.shiftright("node", FAN_BITS).eqNullSafe(col("_parent")), "left_semi")
    ranges = [(n << FAN_BITS, (n << FAN_BITS) + (1 << FAN_BITS) - 1) for n in named if n is not None]
    ranges += [(-(1 << FAN_BITS), -1)] if 0 in named else []    # nodes -1 may hang on 0
    inside = [col("node").between(*r) for r in ranges] + [col("node").isNull()] * (None in named or 0 in named)
    return nodes.filter(reduce(or_, inside, lit(False)))


def differing_rows(a: DataFrame, b: DataFrame, name: str, leaves: DataFrame) -> DataFrame:
    """Keys of the rows in differing leaves that are not in both, with how often they are in each."""
    keys, leaf = list(TABLES[name].primary_key), leaves.select(col("node").alias("_leaf"))

    def counted(frame: DataFrame, side: str) -> DataFrame:
        rows = frame.withColumn("_at", leaf_of(name)).join(leaf, col("_at").eqNullSafe(col("_leaf")), "left_semi")
        return rows.select(*keys, row_hash(name).alias("_hash"), *[lit(int(side == s)).alias(s) for s in ("in_first", "in_second")])

    both = counted(a, "in_first").unionByName(counted(b, "in_second"))
    sums = both.groupBy(*keys, "_hash").agg(F.sum("in_first").alias("in_first"), F.sum("in_second").alias("in_second"))
    unlike = sums.filter(col("in_first") != col("in_second"))
    return unlike.groupBy(*keys).agg(F.sum("in_first").alias("in_first"), F.sum("in_second").alias("in_second"))
