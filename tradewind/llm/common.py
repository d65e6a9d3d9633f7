"""Helpers shared by the operators of this subpackage.

Every operator first selects the columns it reads under private names, so further columns of the
input, whatever they are called, neither disturb it nor reach its result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import scratch

ROWS_PER_BATCH = 1000
WORD_SPACE = b" \t\n\x0b\x0c\r"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, the whole text with null as the empty one, and further named columns."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write below the shared folder of the session and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True where the checksum of the id's text leaves no remainder by five."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def by_batch(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], setup: Callable | None = None
) -> DataFrame:
    """Map Arrow batches in pieces of bounded row count; ``setup()`` runs once per task and is passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(at, ROWS_PER_BATCH)
                yield work(part, state) if setup else work(part)

    return df.mapInArrow(run, schema)


def labelled_sample(labels: DataFrame, column: str, rows: int, rule: Column | None = None, shares: bool = False) -> list:
    """At most ``rows`` labelled ids in the order of a hash of the id; the bound is the caller's parameter.

    With ``shares`` the labels get equal shares; what a rare one leaves of its share goes to the others.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).alias("label"))
    known = known.where("doc_id is not null and label is not null")
    if rule is not None:
        known = known.where(rule)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")]
    if not shares:
        return known.orderBy(*order).limit(rows).collect()
    known = known.persist()
    left, taken = rows, []
    sizes = sorted((r["count"], r.label) for r in known.groupBy("label").count().collect())
    for at, (size, label) in enumerate(sizes):
        share = min(size, -(-left // (len(sizes) - at)))
        taken += known.where(F.col("label") == label).orderBy(*order).limit(share).collect() if share else []
        left -= share
    known.unpersist()
    return taken
