"""Three Structured Streaming jobs over file sources.

Each runs with ``availableNow``: it takes what has arrived, commits, and can be
started again from its checkpoint.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradewind.operators.refresh import PARTITIONS
from tradewind.sources.tables import stored

col = F.col


def _source(spark: SparkSession, schema: T.StructType, path: str, **options) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def ingest_steps(spark: SparkSession, schema: T.StructType, landing: str, target: str,
                 checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Append arriving step files to a table partitioned by step.

    The file sink keeps a log of committed batches, so a restarted batch is
    written once.
    """
    stepped = T.StructType([*schema.fields, T.StructField("step", T.IntegerType())])
    arriving = _source(spark, stepped, landing, maxFilesPerTrigger=str(files_per_batch))
    return (arriving.writeStream.format("parquet").partitionBy("step")
            .option("path", target).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def apply_refresh_sets(spark: SparkSession, orders: T.StructType, lineitem: T.StructType,
                       landing: str, store: str, checkpoint: str) -> list[StreamingQuery]:
    """Copy arriving refresh sets into the store that ``refreshed`` merges.

    Files land below ``orders/refresh=<u>/delivery=<d>``, and so for ``lineitem``
    and ``deletes``; a delivery may come in parts.  Every part is stored under
    the numbers of its set, delivery and batch, so a batch that runs twice
    replaces its own partitions.  ``refreshed`` counts the first delivery of a
    set with all its parts and leaves the others out.
    """
    numbers = [T.StructField("refresh", T.IntegerType()), T.StructField("delivery", T.IntegerType())]
    inputs = {
        "orders": (orders, "orders_inserts"), "lineitem": (lineitem, "lineitem_inserts"),
        "deletes": (T.StructType([T.StructField("key", T.LongType())]), "deletes")}
    queries = []
    for name, (schema, target) in inputs.items():
        arriving = _source(spark, T.StructType([*schema.fields, *numbers]),
                           os.path.join(landing, name))
        queries.append(
            arriving.writeStream.foreachBatch(_store(store, target))
            .option("checkpointLocation", os.path.join(checkpoint, name))
            .trigger(availableNow=True).start())
    return queries


def _store(store: str, target: str):
    path = os.path.join(store, target)

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path))

    return write


WIDTHS = (5, 60)


def report_seconds(duration: float) -> int:
    """Seconds between reports: short jobs report more often."""
    return WIDTHS[0] if duration < 90 else WIDTHS[1]


def report_width(duration: Column) -> Column:
    return F.when(duration < 90, WIDTHS[0]).otherwise(WIDTHS[1])


def throughput_windows(events: DataFrame, seconds: int = 60, delay: str = "1 hour") -> DataFrame:
    """Queries per minute in tumbling windows of event time.

    Events more than ``delay`` behind the newest are dropped; windows are
    emitted once the watermark has passed them.
    """
    counted = (
        events.withColumn("ts", col("ts").cast("timestamp")).withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{seconds} seconds"))
        .agg(F.count("*").alias("queries")))
    return counted.select(
        col("window.start").cast("timestamp_ntz").alias("window_start"),
        col("window.end").cast("timestamp_ntz").alias("window_end"),
        "queries", (col("queries") * F.lit(60.0) / F.lit(seconds)).alias("qpm"))


def stream_throughput(spark: SparkSession, schema: T.StructType, source: str, target: str,
                      checkpoint: str, seconds: int = 60, delay: str = "1 hour",
                      pattern: str = "*.parquet") -> StreamingQuery:
    """Write the windows that the watermark has passed; ``all_windows`` adds the open ones."""
    arriving = _source(spark, schema, source, pathGlobFilter=pattern)
    return (throughput_windows(arriving, seconds, delay)
            .writeStream.outputMode("append").format("parquet")
            .option("path", target).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _still_open(spark: SparkSession, schema: T.StructType, source: str, seconds: int, delay: str, pattern: str) -> tuple[DataFrame, object] | None:
    """Events that a window still open at the end may hold, and the watermark; None without events.

    The windows end after the watermark, so their events are younger than it less the width; that reaches the scan.
    """
    events = spark.read.schema(schema).option("pathGlobFilter", pattern).parquet(source)
    mark = F.max(col("ts").cast("timestamp")) - F.expr(f"interval '{delay}'")
    ends = events.agg(mark.cast("timestamp_ntz").alias("mark"), (mark - F.expr(f"interval {seconds} seconds")).cast("timestamp_ntz").alias("cut")).first()
    if ends.mark is None:
        return None
    return events.filter(col("ts") > F.lit(ends.cut).cast(schema["ts"].dataType)), F.lit(ends.mark).cast("timestamp_ntz")


def all_windows(spark: SparkSession, schema: T.StructType, source: str, target: str, seconds: int = 60,
                delay: str = "1 hour", pattern: str = "*.parquet") -> DataFrame:
    """The written windows and those still open when the source was closed.

    An open window ends after the watermark, so none of its events was late: the events
    themselves give it.
    """
    return _with_open(spark, schema, source, target, seconds, delay, pattern, lambda events: throughput_windows(events, seconds, delay))


def _with_open(spark, schema, source, target, seconds, delay, pattern, windows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    written, left = stored(spark, *os.path.split(target)), _still_open(spark, schema, source, seconds, delay, pattern)
    if left is None:
        return windows(spark.createDataFrame([], schema)) if written is None else written
    still_open = windows(left[0]).filter(col("window_end") > left[1])
    return still_open if written is None else written.select(still_open.columns).unionByName(still_open)


def job_windows(events: DataFrame, jobs: DataFrame, closing: str, delay: str = "1 hour") -> DataFrame:
    """Finished streams and queries of every job in its report intervals.

    ``jobs`` (``job, planned``) says how long a job is meant to run: one below 90 seconds reports every 5, others every 60.  The
    query named ``closing`` ends a stream.  Each width is a windowed aggregation of its own, so a job's state is
    dropped once the watermark has passed its interval, whatever the width.
    """
    timed = events.withColumn("ts", col("ts").cast("timestamp")).withWatermark("ts", delay)
    known = jobs.select(col("job").alias("_job"), report_width(col("planned")).alias("seconds"))
    planned = timed.join(known, col("job") == col("_job")).drop("_job")
    parts = [planned.filter(col("seconds") == width).groupBy("job", F.window("ts", f"{width} seconds")).agg(
        F.count_if(col("name") == closing).alias("streams"), F.count("*").alias("queries")).withColumn("seconds", F.lit(width)) for width in WIDTHS]
    return parts[0].unionByName(parts[1]).select(
        "job", "seconds", col("window.start").cast("timestamp_ntz").alias("window_start"),
        col("window.end").cast("timestamp_ntz").alias("window_end"), "streams", "queries")


def stream_job_windows(spark: SparkSession, schema: T.StructType, source: str, jobs: DataFrame, read: Callable[[DataFrame], DataFrame], closing: str,
                       target: str, checkpoint: str, delay: str = "1 hour", pattern: str = "*.parquet") -> StreamingQuery:
    """Write the intervals that the watermark has passed; ``read`` gives ``job, name, ts`` of the source's rows."""
    arriving = _source(spark, schema, source, pathGlobFilter=pattern)
    return (job_windows(read(arriving), jobs, closing, delay)
            .writeStream.outputMode("append").format("parquet")
            .option("path", target).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def job_reports(spark: SparkSession, schema: T.StructType, source: str, jobs: DataFrame, read: Callable[[DataFrame], DataFrame], closing: str,
                target: str, delay: str = "1 hour", pattern: str = "*.parquet") -> DataFrame:
    """One report for each interval in which a job finished a query: what it has done since its first one.

    A job has as many rows as intervals, however many queries it ran.
    """
    windows = _with_open(spark, schema, source, target, max(WIDTHS), delay, pattern, lambda rows: job_windows(read(rows), jobs, closing, delay))
    so_far = Window.partitionBy("job").orderBy("window_start")
    seconds = F.unix_timestamp(col("window_end").cast("timestamp")) - F.unix_timestamp(F.min("window_start").over(so_far).cast("timestamp"))
    done = windows.select("*", F.sum("streams").over(so_far).alias("all_streams"), F.sum("queries").over(so_far).alias("all_queries"), seconds.alias("elapsed"))
    return done.withColumn("qpm", F.round(col("all_queries") * 60 / col("elapsed"), 6))
