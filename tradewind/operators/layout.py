"""A layout for filters on any of several columns.

A lexicographic order serves its first column: within one day of shipping, discounts and quantities are all over the file, so
the least and greatest values of a file say nothing about them.  Here each column is turned into its rank among
quantiles, and rows are ordered along a Z-curve, the ranks' bits dealt in turn, so that a file covers a small box in all columns.

Ranks come from an approximate summary of each column (one pass for all), are found in two steps of 32 comparisons in the map task, and
the Z-value is arithmetic on them: no join and no UDF.  Values that many rows share have one rank; rows of one Z-value are spread over
files by the primary key.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.schema import TABLES

col = F.col
STEP_BITS = 5           # bits of a rank that one step of comparisons decides
BITS = 2 * STEP_BITS    # bits of a rank
ACCURACY = 10_000
# Columns that questions filter by besides the leading one of the sorted layout.
Z_KEYS = {"lineitem": ["l_shipdate", "l_discount", "l_quantity"], "orders": ["o_orderdate", "o_totalprice"]}


def _number(column: str, kind: str) -> Column:
    return F.unix_date(col(column)).cast("double") if kind == "date" else col(column).cast("double")


def quantiles(frame: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """For each column the first values of 2^BITS equal parts but the first; as many numbers reach the driver."""
    kinds, parts = dict(frame.dtypes), 1 << BITS
    at = [n / parts for n in range(1, parts)]
    row = frame.agg(*[F.percentile_approx(_number(c, kinds[c]), at, ACCURACY).alias(c) for c in columns]).first()
    return {c: list(row[c] or []) for c in columns}


def rank(value: Column, bounds: list[float]) -> Column:
    """How many of the sorted bounds do not exceed the value; null counts as the least."""
    if not bounds:
        return F.lit(0)
    step = 1 << STEP_BITS
    groups = [bounds[at: at + step] for at in range(0, len(bounds), step)]
    whole = lambda numbers: F.lit("[" + ",".join(map(repr, numbers)) + "]")
    firsts = F.from_json(whole([g[0] for g in groups]), "array<double>")
    inner = F.from_json(F.lit("[" + ",".join("[" + ",".join(map(repr, g)) + "]" for g in groups) + "]"), "array<array<double>>")
    group = F.size(F.filter(firsts, lambda b: b <= value))
    within = F.size(F.filter(F.get(inner, group - 1), lambda b: b <= value))
    return F.when(value.isNull() | (group == 0), 0).otherwise((group - 1) * step + within)


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """The ranks' bits dealt in turn, the highest first."""
    places = [(bit, at) for bit in range(bits) for at in range(len(ranks))]
    taken = [F.shiftleft(F.shiftright(ranks[at].cast("bigint"), bit).bitwiseAND(F.lit(1)), bit * len(ranks) + len(ranks) - 1 - at) for bit, at in places]
    return reduce(lambda a, b: a + b, taken)


def z_value(frame: DataFrame, columns: list[str]) -> Column:
    kinds, bounds = dict(frame.dtypes), quantiles(frame, columns)
    return interleaved([rank(_number(c, kinds[c]), bounds[c]) for c in columns])


def write_zordered(frame: DataFrame, folder: str, name: str, partitions: int | None = None, columns: list[str] | None = None) -> str:
    """Write a table in the order of its Z-values; the files' statistics then narrow each of the columns."""
    columns = columns or Z_KEYS[name]
    ranked = frame.withColumn("_z", z_value(frame, columns))
    order = ["_z", *TABLES[name].primary_key]
    ranged = ranked.repartitionByRange(partitions, *order) if partitions else ranked.repartitionByRange(*order)
    path = os.path.join(folder, name)
    ranged.sortWithinPartitions(*order).drop("_z").write.mode("overwrite").parquet(path)
    return path


def boxes(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Per file the rows and the least and greatest value of each column: what a scan can skip by."""
    bounds = [f(c).alias(f"{c}_{label}") for c in columns for f, label in ((F.min, "low"), (F.max, "high"))]
    return frame.select(*columns, col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("rows"), *bounds)
