"""Flat files: separated text without header, money as d.cc, dates as ISO text."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.schema import TABLES, Column
from tradewind.session import stored

# Quoting is off: no value holds a separator, and empty text must stay empty.
_PLAIN = {"header": "false", "quote": "", "escape": "", "emptyValue": "",
          "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
          "dateFormat": "yyyy-MM-dd"}


def _as_text(frame: DataFrame, name: str) -> DataFrame:
    table = TABLES[name]
    carried = [c for c in frame.columns if c not in table.column_names]
    return frame.select(
        *[F.col(c).cast("decimal(18,2)").cast("string").alias(c) if c in table.money
          else F.col(c) for c in table.column_names], *carried)


def write_pipe(frame: DataFrame, folder: str, name: str, step: int = 1) -> str:
    """One table step below ``<folder>/<name>.tbl/step=<step>``, separated by ``|``.

    Writing a step again replaces just that step.
    """
    path = os.path.join(folder, f"{name}.tbl")
    (_as_text(frame, name).withColumn("step", F.lit(step))
     .write.mode("overwrite").partitionBy("step")
     .option("partitionOverwriteMode", "dynamic").options(sep="|", **_PLAIN).csv(path))
    return path


def read_pipe(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A ``|`` file or folder; lines may end in a separator."""
    table = TABLES[name]
    wide = T.StructType([*table.struct.fields, T.StructField("_tail", T.StringType())])
    rows = spark.read.schema(wide).options(sep="|", **_PLAIN).csv(path)
    # An empty field of a text column is an empty text, not an absent one.
    return rows.select(*[
        F.coalesce(c.name, F.lit("")).alias(c.name)
        if c.dtype == T.StringType() and not c.nullable else F.col(c.name)
        for c in table.columns])


def _problem(column: Column, field: "F.Column") -> "F.Column":
    """What is wrong with a field, or null."""
    bad = lambda what, when: F.when(when, F.lit(f"{column.name}: {what}"))
    if column.dtype == T.StringType():
        return bad("too long", F.length(field) > column.max_len) if column.max_len else F.lit(None).cast("string")
    missing = F.lit(False) if column.nullable else field == ""
    kind = column.dtype.simpleString()
    return F.coalesce(bad("missing", missing), bad(f"no {kind}", (field != "") & field.try_cast(kind).isNull()))


def _value(column: Column, field: "F.Column") -> "F.Column":
    if column.dtype == T.StringType():
        return F.when(field != "", field) if column.nullable else field
    return field.try_cast(column.dtype)


def read_pipe_checked(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The good rows of ``|`` files, and ``file, line, reason, text`` of every line that is none.

    The files are read once, into a stored copy of both.  A line is good if it has as many fields as the table has columns (an
    empty one may follow), its numbers and dates can be read, mandatory ones are there and no text is too long.  Lines count from 1 in
    their file; a file that several tasks read is put together from the lines of its pieces, of which there is one row each.
    """
    columns = TABLES[name].columns
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_piece"))
    rows = lines.select("*", F.monotonically_increasing_id().alias("_at"), F.split("value", "\\|", -1).alias("_fields"))
    fields = F.size("_fields")
    whole = (fields == len(columns)) | (fields == len(columns) + 1) & (F.element_at("_fields", -1) == "")
    # Not evaluated for lines of other lengths.
    field = lambda at: F.get("_fields", F.lit(at))
    problems = F.coalesce(*[_problem(c, field(at)) for at, c in enumerate(columns)])
    reason = F.when(whole, problems).otherwise(F.concat(fields.cast("string"), F.lit(f" fields instead of {len(columns)}")))
    parsed = stored(rows.select(
        "_file", "_piece", "_at", reason.alias("_reason"), F.when(reason.isNotNull(), F.col("value")).alias("_text"),
        *[F.when(reason.isNull(), _value(c, field(at))).alias(c.name) for at, c in enumerate(columns)]), "flat-file")
    pieces = parsed.groupBy(F.col("_file").alias("_of"), F.col("_piece").alias("_start")).agg(F.count("*").alias("_lines"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_lines").over(Window.partitionBy("_of").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rejects = parsed.filter(F.col("_reason").isNotNull()).join(
        pieces.withColumn("_before", before), (F.col("_file") == F.col("_of")) & (F.col("_piece") == F.col("_start")))
    good = parsed.filter(F.col("_reason").isNull()).select(*[c.name for c in columns])
    return good, rejects.select(F.col("_file").alias("file"), (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"),
                                F.col("_reason").alias("reason"), F.col("_text").alias("text"))


def write_tabs(frame: DataFrame, folder: str, name: str, step: int = 1) -> str:
    """One table step as tab-separated text with ``\\N`` for null."""
    path = os.path.join(folder, f"{name}.copy")
    (_as_text(frame, name).withColumn("step", F.lit(step))
     .write.mode("overwrite").partitionBy("step")
     .option("partitionOverwriteMode", "dynamic")
     .options(sep="\t", nullValue="\\N", **_PLAIN).csv(path))
    return path


def read_tabs(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name].struct).options(
        sep="\t", nullValue="\\N", **_PLAIN).csv(path).select(*TABLES[name].column_names)
