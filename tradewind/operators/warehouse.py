"""Loading, growing, laying out and dropping the eight tables."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import quality
from tradewind.operators.ordered import id_block, row_numbers
from tradewind.schema import TABLES
from tradewind.session import stored
from tradewind.sources.tables import Catalog

col = F.col

# Keys that many joins meet on, and how many rows one value may have in the model.
BUCKET_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey",
               "part": "p_partkey", "partsupp": "ps_partkey"}

# Sort orders that turn file and row-group statistics into an index.
SORT_KEYS = {
    "lineitem": ["l_shipdate", "l_discount", "l_quantity"],
    "orders": ["o_orderdate"],
    "customer": ["c_nationkey"],
    "supplier": ["s_nationkey"],
    "partsupp": ["ps_partkey", "ps_suppkey"],
}
YEAR_OF = {"lineitem": "l_shipdate", "orders": "o_orderdate"}


# -- steps ------------------------------------------------------------------

def append_step(frame: DataFrame, folder: str, name: str, step: int) -> None:
    """Add one step of a table below ``<folder>/<name>/step=<step>``.

    Only that step is replaced, so repeating a load leaves no copies.
    """
    (frame.withColumn("step", F.lit(step)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("step")
     .parquet(os.path.join(folder, name)))


def load_step(generator, folder: str) -> None:
    """Generate and append every table of a step; small tables come with step one."""
    for name in TABLES:
        if name in ("region", "nation") and generator.step > 1:
            continue
        append_step(generator.table(name), folder, name, generator.step)


def boundary_keys(keys: DataFrame, key: str, runs: int) -> list[int]:
    """First keys of runs 2 to ``runs`` of unique keys: equal runs in key order, the last takes the remainder.

    Only keys move, once and to their block of ids; ``runs - 1`` numbers reach the driver.
    """
    numbered = row_numbers(keys.select(key).withColumn("_block", id_block(key)), [], "_block", key, "_row")
    size = max(1, keys.count() // runs)
    starts = numbered.filter(((col("_row") - 1) % size == 0) & col("_row").between(size + 1, size * (runs - 1) + 1))
    return [row[0] for row in starts.select(key).orderBy(key).collect()]


def run_of(key: str, boundaries: list[int]) -> Column:
    """Number of the run that a key lies in, found by comparison in the map task."""
    return F.lit(1) + sum([(col(key) >= first).cast("int") for first in boundaries], F.lit(0))


def numbered_steps(frame: DataFrame, key: str, children: int) -> DataFrame:
    """Add ``step``: equal runs of rows in key order, the last takes the remainder."""
    return frame.withColumn("step", run_of(key, boundary_keys(frame, key, children)))


# -- databases --------------------------------------------------------------

def create_tables(c: Catalog, database: str, location: str, step: int = 1) -> None:
    """Load every table as a step of its folder and put a table over the folder."""
    spark = c.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLES:
        append_step(getattr(c, name), location, name, step)
        path = os.path.join(location, name)
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet OPTIONS (path '{path}')")
        spark.catalog.recoverPartitions(f"{database}.{name}")


def drop_tables(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {database}.cardinalities")
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def analyze_tables(spark: SparkSession, database: str, names: list[str] | None = None, bins: int = 0) -> None:
    """Row counts and column statistics for the cost-based optimizer.

    With ``bins``, also equi-height histograms of so many bins: a filter on a skewed column is then taken for what it
    selects, not for its part of the column's range.  They take a second pass over the columns.
    """
    settings = {"spark.sql.statistics.histogram.enabled": str(bins > 1).lower(), "spark.sql.statistics.histogram.numBins": str(max(bins, 2))}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for name in names or TABLES:
            spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS FOR ALL COLUMNS")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def table_statistics(spark: SparkSession, database: str) -> DataFrame:
    """Per table the rows, and the least and greatest leading key, as the stored statistics have them."""
    frames = []
    for name, table in TABLES.items():
        key = table.primary_key[0]
        whole = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").filter(col("col_name") == "Statistics").agg(
            F.max(F.regexp_extract("data_type", r"(\d+) rows", 1)).cast("bigint").alias("rows"))
        column = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name} {key}").agg(*[
            F.max(F.when(col("info_name") == item, col("info_value"))).cast("bigint").alias(alias)
            for item, alias in (("min", "least_key"), ("max", "greatest_key"))])
        frames.append(whole.withColumn("table_name", F.lit(name)).join(
            column.withColumn("of", F.lit(name)), col("table_name") == col("of")).drop("of"))
    return reduce(DataFrame.unionByName, frames)


def warm_cache(spark: SparkSession, database: str, tables: list[str]) -> None:
    """Read the listed tables into the cache now; they stay, with spill to disk, until they are released."""
    for name in tables:
        spark.sql(f"CACHE TABLE {database}.{name}")


def release_cache(spark: SparkSession, database: str, tables: list[str]) -> None:
    for name in tables:
        spark.sql(f"UNCACHE TABLE IF EXISTS {database}.{name}")


class Database(Catalog):
    """The catalog interface over saved tables."""

    def __init__(self, spark: SparkSession, database: str):
        super().__init__(spark, database)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        declared = [c.name for c in TABLES[name].columns]
        return self.spark.table(f"{self.folder}.{name}").select(*declared)


def initial_load(c: Catalog, database: str, location: str) -> DataFrame:
    """Drop, create, load, analyze, check all keys and lay the fact tables out; one report.

    ``stage, object_name, value``: rows by the statistics, repeated or null primary keys, orphan rows of every
    reference, and rows of the laid-out copies below ``<location>_clustered``.
    """
    drop_tables(c.spark, database)
    create_tables(c, database, location)
    analyze_tables(c.spark, database)
    loaded = Database(c.spark, database)
    line = lambda frame, stage, name, value: frame.select(
        F.lit(stage).alias("stage"), col(name).alias("object_name"), F.expr(value).cast("bigint").alias("value"))
    stages = [
        line(table_statistics(c.spark, database), "load", "table_name", "rows"),
        line(quality.primary_keys(loaded), "primary key", "table_name", "repeated_keys + null_keys"),
        line(quality.foreign_keys(loaded), "foreign key", "constraint_name", "orphan_rows")]
    for name in YEAR_OF:
        path = write_clustered(getattr(loaded, name), f"{location}_clustered", name)
        counted = c.spark.read.parquet(path).agg(F.count("*").alias("n")).withColumn("name", F.lit(name))
        stages.append(line(counted, "layout", "name", "n"))
    return stored(reduce(DataFrame.unionByName, stages), "initial-load")


# -- layout -----------------------------------------------------------------

def write_clustered(frame: DataFrame, folder: str, name: str, partitions: int | None = None) -> str:
    """Range-cluster a table so that filters on its sort keys skip files.

    The primary key ends the range key: rows that agree on the leading columns
    still spread over partitions, however many there are.
    """
    keys = SORT_KEYS.get(name, []) + [
        k for k in TABLES[name].primary_key if k not in SORT_KEYS.get(name, [])]
    ranged = (frame.repartitionByRange(partitions, *keys) if partitions
              else frame.repartitionByRange(*keys))
    path = os.path.join(folder, name)
    if name in YEAR_OF:
        yearly = ranged.withColumn("year", F.year(YEAR_OF[name])).sortWithinPartitions("year", *keys)
        yearly.write.mode("overwrite").partitionBy("year").parquet(path)
    else:
        ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return path


def hottest_share(frame: DataFrame, key: str) -> DataFrame:
    """One row: the rows, and the largest number and share of them that one key value has.

    A bucket is read by one task; ask this before choosing keys and buckets of a table with uneven keys.
    """
    counts = frame.groupBy(key).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.max("n").alias("hottest"),
                      F.try_divide(F.max("n"), F.sum("n")).alias("share"))


def buckets_for(data_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """Number of buckets that keeps a bucket of evenly spread keys near ``bucket_bytes``."""
    return max(1, -(-data_bytes // bucket_bytes))


def write_bucketed(frame: DataFrame, table: str, keys: str | list[str], path: str, buckets: int) -> None:
    """Bucket a table on its join keys, so joins of tables bucketed alike need no shuffle.

    A second key splits the rows of a hot first one; both tables of a join need the same keys.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    (frame.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
