"""Refresh sets: new orders with their lines, and keys of orders to delete.

Sets are stored beside the base table, one partition per set and delivery, and
merged when read.  Applying a set writes only that set: at any table size the
cost is the size of the set.  Of the deliveries of a set the one with the
smallest number counts, with all its parts; that is read from the names of the
partitions, so delivering or writing a set again neither loses nor doubles rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.warehouse import boundary_keys, run_of
from tradewind.sources.tables import Catalog, stored

col, lit = F.col, F.lit

KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
PARTITIONS = ("refresh", "delivery", "batch")


def insert_orders(base: DataFrame, fresh: DataFrame) -> DataFrame:
    """Append the rows of an insert set."""
    return base.unionByName(fresh)


def delete_orders(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Remove the rows of the orders named by a key list."""
    gone = keys.select(col(keys.columns[0]).alias("_gone")).distinct()
    return base.join(gone, col(key) == col("_gone"), "left_anti")


def write_insert_set(spark: SparkSession, folder: str, number: int,
                     orders: DataFrame, lineitem: DataFrame) -> None:
    for name, rows in (("orders", orders), ("lineitem", lineitem)):
        _write_set(rows, os.path.join(folder, f"{name}_inserts"), number)


def write_delete_set(spark: SparkSession, folder: str, number: int, keys: DataFrame) -> None:
    rows = keys.select(col(keys.columns[0]).alias("key"))
    _write_set(rows, os.path.join(folder, "deletes"), number)


def _write_set(rows: DataFrame, path: str, number: int) -> None:
    (rows.withColumns({"refresh": lit(number), "delivery": lit(1), "batch": lit(0).cast("bigint")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITIONS).parquet(path))


def counting(spark: SparkSession, folder: str, name: str, after: int = 0, upto: int | None = None) -> DataFrame | None:
    """The stored rows of the first delivery of every set, or of the sets behind ``after`` up to ``upto``; None if nothing was ever stored.

    The numbers are partitions, so the folders of other sets are not read.
    """
    rows = stored(spark, folder, name)
    if rows is None:
        return None
    rows = rows.filter(col("refresh") > after)
    rows = rows if upto is None else rows.filter(col("refresh") <= upto)
    firsts = rows.groupBy(col("refresh").alias("_set")).agg(F.min("delivery").alias("_first"))
    return rows.join(firsts, (col("refresh") == col("_set")) & (col("delivery") == col("_first")), "left_semi")


def latest_deletes(deletes: DataFrame) -> DataFrame:
    """``_gone, _last``: each deleted key and the last set that deletes it."""
    return deletes.groupBy(col("key").alias("_gone")).agg(F.max("refresh").alias("_last"))


def merged(rows: DataFrame, folder: str, name: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """Rows of ``orders`` or ``lineitem`` with the stored sets behind ``after``, up to ``upto``, applied.

    A delete set removes base rows and rows of insert sets up to its own number.
    """
    spark, key = rows.sparkSession, KEYS[name]
    rows = rows.withColumn("refresh", lit(0))
    fresh, deletes = counting(spark, folder, f"{name}_inserts", after, upto), counting(spark, folder, "deletes", after, upto)
    if fresh is not None:
        rows = rows.unionByName(fresh.select(*rows.columns))
    if deletes is not None:
        rows = rows.join(latest_deletes(deletes), (col(key) == col("_gone")) & (col("refresh") <= col("_last")), "left_anti")
    return rows.drop("refresh")


def refreshed(base: Catalog, folder: str, name: str) -> DataFrame:
    """``orders`` or ``lineitem`` with every stored set applied."""
    return merged(getattr(base, name), folder, name)


def segments(rows: DataFrame, key: str, count: int) -> DataFrame:
    """Add ``segment`` 1..count: equal runs of keys, so an order stays with its lines.

    The first keys of the runs are found among the distinct keys; each row then compares its own.
    """
    return rows.withColumn("segment", run_of(key, boundary_keys(rows.select(key).distinct(), key, count)))
