"""Ordered prefixes over groups of any size.

A window over a whole group runs in one task, which fails when one group holds
a third of all rows.  Here the caller names a ``block``: a column that splits
each group into bounded, ordered ranges (for example ``id div 2^20``).  Windows
run per (group, block); a second window runs over the one-row-per-block totals
and the two are added, so the result is exact and no task sees a whole group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import stored

BLOCK_BITS = 20
LIMIT = 4096


def id_block(key: str, bits: int = BLOCK_BITS) -> Column:
    """Block of a unique integer key: at most ``2^bits`` rows per block."""
    return F.shiftright(F.col(key), bits)


def _before(keys: list[str], order: str):
    window = Window.partitionBy(*keys) if keys else Window
    return window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def prefix_sum(frame: DataFrame, group: list[str], block: str, order: str,
               value: Column, name: str, total: str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one in its group.

    ``total`` names an optional extra column with the sum over the whole group.
    """
    keys = [*group, block]
    valued = frame.withColumn("_value", value)
    sums = valued.groupBy(*keys).agg(F.sum("_value").alias("_sum"))
    offsets = sums.select(
        *keys, F.coalesce(F.sum("_sum").over(_before(group, block)), F.lit(0)).alias("_offset"),
        *([F.sum("_sum").over(Window.partitionBy(*group)).alias(total)] if total else []))
    within = F.coalesce(F.sum("_value").over(_before(keys, order)), F.lit(0))
    return (
        valued.withColumn("_within", within).join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.col("_within"))
        .drop("_value", "_within", "_offset"))


def row_numbers(frame: DataFrame, group: list[str], block: str, order: str,
                name: str) -> DataFrame:
    """Add ``name``: 1, 2, 3 … in ``order`` within each group."""
    counted = prefix_sum(frame, group, block, order, F.lit(1).cast("bigint"), name)
    return counted.withColumn(name, F.col(name) + 1)


def last_block(frame: DataFrame, block: str, rows: int) -> int | None:
    """The block in which the first ``rows`` rows end, nulls first; None if there are fewer."""
    sums = frame.groupBy(block).agg(F.count("*").alias("_n"))
    reached = sums.withColumn("_upto", F.col("_n") + F.coalesce(F.sum("_n").over(_before([], block)), F.lit(0)))
    return reached.filter((F.col("_upto") >= rows) & F.col(block).isNotNull()).agg(F.min(block)).first()[0]


def carry_forward(frame: DataFrame, group: list[str], block: str, order: str,
                  value: str, name: str) -> DataFrame:
    """Add ``name``: the latest non-null ``value`` strictly before this row."""
    keys = [*group, block]
    lasts = frame.groupBy(*keys).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last"))
    carried = lasts.select(
        *keys, F.last("_last", ignorenulls=True).over(_before(group, block)).alias("_carried"))
    within = F.last(value, ignorenulls=True).over(_before(keys, order))
    return (
        frame.withColumn("_within", within).join(carried, keys)
        .withColumn(name, F.coalesce("_within", "_carried"))
        .drop("_within", "_carried"))


def exact_percentiles(frame: DataFrame, group: list[str], value: str,
                      points: dict[str, float], limit: int = LIMIT) -> DataFrame:
    """Interpolated percentiles per group, one column per entry of ``points``.

    Values are counted per (group, value).  Each wanted rank has a bracket of values, at first the whole
    range of its group; a bracket with more than ``limit`` values is cut into ``limit`` equal
    parts, counted, and replaced by the part that holds the rank, until all are small enough to sort.
    So no task ever orders more than ``limit`` rows of a group, whatever its size.
    """
    rows = frame.filter(F.col(value).isNotNull())
    counted = stored(rows.groupBy(*group, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n")), "percentiles")
    totals = counted.groupBy(*group).agg(
        F.sum("_n").alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_values"))
    place = lambda point: (F.col("_rows") - 1) * F.lit(float(point))
    ranks = F.array_distinct(F.array(*[f(place(p)).cast("bigint") for p in points.values() for f in (F.floor, F.ceil)]))
    wanted = stored(totals.select(*group, "_rows", F.explode(ranks).alias("_rank"), "_lo", "_hi", "_values",
                                  F.lit(0).cast("bigint").alias("_before")), "percentiles")
    while not wanted.filter(F.col("_values") > limit).isEmpty():
        wide, fine = wanted.filter(F.col("_values") > limit), wanted.filter(F.col("_values") <= limit)
        brackets = wide.select(*[F.col(g).alias(f"_{g}") for g in group], "_lo", "_hi", "_before").distinct()
        inside = counted.join(brackets, _same(group) & F.col("_v").between(F.col("_lo"), F.col("_hi")))
        part = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * limit), F.lit(limit - 1))
        parts = inside.groupBy(*group, "_lo", "_before", part.alias("_part")).agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_first"), F.max("_v").alias("_last"), F.count("*").alias("_inside"))
        start = F.col("_before") + F.coalesce(F.sum("_n").over(_before([*group, "_lo"], "_part")), F.lit(0))
        parts = parts.withColumn("_start", start).select(
            *[F.col(g).alias(f"_{g}") for g in group], F.col("_lo").alias("_of"), "_n", "_first", "_last", "_inside", "_start")
        cut = wide.join(parts, _same(group) & (F.col("_lo") == F.col("_of")) & (F.col("_rank") >= F.col("_start"))
                        & (F.col("_rank") < F.col("_start") + F.col("_n")))
        wanted = stored(fine.unionByName(cut.select(
            *group, "_rows", "_rank", F.col("_first").alias("_lo"), F.col("_last").alias("_hi"),
            F.col("_inside").alias("_values"), F.col("_start").alias("_before"))), "percentiles")
    small = wanted.select(*[F.col(g).alias(f"_{g}") for g in group], "_rows", "_rank", "_lo", "_hi", "_before")
    near = counted.join(small, _same(group) & F.col("_v").between(F.col("_lo"), F.col("_hi")))
    start = F.col("_before") + F.coalesce(F.sum("_n").over(_before([*group, "_rank"], "_v")), F.lit(0))
    found = near.withColumn("_start", start).filter(
        (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_n")))

    def between(point: float) -> Column:
        at = lambda rank: F.max(F.when(F.col("_rank") == rank.cast("bigint"), F.col("_v")))
        low = F.floor(place(point))
        return at(low) + (at(F.ceil(place(point))) - at(low)) * F.max(place(point) - low)

    return found.groupBy(*group).agg(*[between(p).alias(name) for name, p in points.items()])


def _same(group: list[str]) -> Column:
    """Equality of a group's columns with their copies that start with an underscore."""
    return reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group], F.lit(True))
