"""Tracking tables: dumps as tab-separated text, and a derivation from ``events``."""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.money import exact_sum, micros, money
from tradewind.schema import TRACKING

# The text form of copied tables.
DUMP_OPTIONS = {"sep": "\t", "nullValue": "\\N", "quote": "", "escape": "",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


@dataclass(frozen=True)
class Tracking:
    """Runs, their jobs, and the queries of those jobs."""
    run: DataFrame
    job: DataFrame
    query: DataFrame

    def replace(self, **frames: DataFrame) -> "Tracking":
        return replace(self, **frames)

    def items(self):
        return (("run", self.run), ("job", self.job), ("query", self.query))


def from_events(events: DataFrame) -> Tracking:
    """One job per user, one query per event of the users that are not loaders."""
    user = F.col("user_id")
    loads = user % 3 == 0
    job = (
        events.groupBy("user_id")
        .agg(F.min("ts").alias("start"), F.expr(exact_sum(micros("value"))).alias("total"))
        .select(
            user.alias("id"), (user % 5 + 1).alias("run"),
            F.when(loads, F.concat(F.lit("load"), user.cast("string")))
             .when(user % 3 == 1, "single-user-stream").otherwise("multi-user-stream")
             .alias("name"),
            "start", F.expr(money("total", 6)).alias("duration"),
            F.when(loads, F.sequence((user + 1).cast("int"), (user + 3).cast("int")))
             .alias("steps")))
    run = (
        job.groupBy(F.col("run").alias("id")).agg(F.min("start").alias("start"))
        .select(
            "id", F.concat(F.lit("run_"), F.col("id").cast("string")).alias("name"),
            F.concat(F.lit("sys_"), (F.col("id") % 3).cast("string")).alias("system"),
            F.lit(None).cast("string").alias("setup"), F.lit("full").alias("schedule"),
            "start", F.lit(None).cast("double").alias("duration"), F.lit(1).alias("sf")))
    query = events.filter(~loads).select(
        F.col("event_id").alias("id"), user.alias("job"),
        F.col("event_type").alias("name"), F.col("value").alias("duration"))
    return Tracking(run, job, query)


def write_dump(tables: Tracking, folder: str) -> None:
    """Each table as tab-separated lines, arrays written as ``{a,b,c}``."""
    for name, frame in tables.items():
        columns = [
            F.concat(F.lit("{"), F.concat_ws(",", F.col(f.name).cast("array<string>")),
                     F.lit("}")).alias(f.name)
            if isinstance(f.dataType, T.ArrayType) else
            F.col(f.name).cast("timestamp").alias(f.name)
            if f.dataType.typeName().startswith("timestamp") else F.col(f.name)
            for f in frame.schema.fields]
        nulls_kept = [F.when(F.col(f.name).isNotNull(), c).alias(f.name)
                      for f, c in zip(frame.schema.fields, columns)]
        (frame.select(*nulls_kept).write.mode("overwrite").options(**DUMP_OPTIONS)
         .csv(os.path.join(folder, name)))


def read_dump(spark: SparkSession, folder: str) -> Tracking:
    frames = {}
    for name, schema in TRACKING.items():
        flat = T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType)
                          else f.dataType) for f in schema.fields])
        stored = spark.read.schema(flat).options(**DUMP_OPTIONS).csv(os.path.join(folder, name))
        frames[name] = stored.select(*[
            F.split(F.regexp_extract(f.name, r"^\{(.*)\}$", 1), ",").cast(f.dataType).alias(f.name)
            if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in schema.fields])
    return Tracking(**frames)


def read_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of ``log=<name>/part=<n>/*`` text files as (log, block, pos, line).

    A long log may be cut into parts.  ``block`` orders the splits Spark reads
    (part number, then byte offset), so a large file stays parallel, and
    ``pos`` orders the lines within one split.
    """
    return (
        spark.read.text(folder).select(
            F.col("log").cast("string").alias("log"),
            F.struct(F.col("part").cast("bigint").alias("part"),
                     F.col("_metadata.file_block_start").alias("offset")).alias("block"),
            F.monotonically_increasing_id().alias("pos"),
            F.col("value").alias("line")))


def write_packed_logs(lines: DataFrame, path: str) -> None:
    """(log, block, pos, line) rows as text files that many logs share.

    Each line follows the log's name and the block, with tabs between, so there are as many files as tasks, however many
    logs.  All lines of a log's block lie in one file, in order.  Names hold no tab and no line end.
    """
    before = F.concat(F.coalesce("log", F.lit("")), F.lit("\t"), F.coalesce(F.col("block").cast("string"), F.lit("")), F.lit("\t"))
    # A line with line ends in it is read as several.
    pieces = F.transform(F.split("line", "\r\n|\r|\n", -1), lambda piece: F.concat(before, piece))
    (lines.repartition("log", "block").sortWithinPartitions("log", "block", "pos")
     .select(F.array_join(pieces, "\n").alias("value")).write.text(path))


def read_packed_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of packed logs as (log, block, pos, line), ordered as ``read_logs`` orders them."""
    field = lambda n: F.nullif(F.split("value", "\t", 3)[n], F.lit(""))
    return spark.read.text(path).select(
        field(0).alias("log"),
        F.struct(field(1).cast("bigint").alias("part"), F.col("_metadata.file_block_start").alias("offset")).alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.split("value", "\t", 3)[2].alias("line"))


def logs_from_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Log lines and the planned query names of every stream job, from ``events``.

    Each event prints a statement, a result and its timing; every seventh also
    prints a timing without a statement, which must not count.
    """
    streams = events.filter(F.col("user_id") % 3 != 0)
    timing = F.concat(F.lit("Time: "), F.col("value").cast("string"), F.lit(" ms"))
    orphan = F.when(F.col("event_id") % 7 == 0, F.lit("Time: 0.001 ms"))
    lines = (
        streams.select(
            F.col("user_id").cast("string").alias("log"), "event_id",
            F.posexplode(F.array(orphan, F.lit("select"), F.col("event_type"), timing))
            .alias("nth", "line"))
        .filter(F.col("line").isNotNull())
        .select("log", F.shiftright("event_id", 18).alias("block"),
                (F.col("event_id") * 4 + F.col("nth")).alias("pos"), "line"))
    return lines, streams.select(
        F.col("user_id").cast("string").alias("log"), "event_id",
        F.col("event_type").alias("name"))
