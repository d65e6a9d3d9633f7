"""Percentiles from mergeable sketches, where close ranks are enough.

``exact_percentiles`` reads every duration of a group each time it is asked.  Here each (job, query) leaves one sketch of bounded size (KLL) when it is registered, and a
report merges sketches: over jobs, runs or systems, without the durations.  With the default size a
quantile's rank is off by about 1.3 % of the rows (``rank_error``), however many sketches are merged.  Exact percentiles remain the default of all reports; they interpolate
between values, a sketch gives one of the values.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 200


def rank_error(size: int = SIZE) -> float:
    """Half-width of the rank interval that holds with about 99 % confidence."""
    return 2.446 / size**0.9433


def sketches(rows: DataFrame, group: list[str], value: str, size: int = SIZE) -> DataFrame:
    """One row a group: ``sketch`` of its values; groups with nulls only have none."""
    known = rows.filter(F.col(value).isNotNull())
    return known.groupBy(*group).agg(F.expr(f"kll_sketch_agg_double(cast({value} as double), {size})").alias("sketch"))


def register(rows: DataFrame, folder: str, batch: int, size: int = SIZE) -> None:
    """Store the sketches of newly registered queries (``job, name, duration``); a batch that is written again replaces itself."""
    made = sketches(rows, ["job", "name"], "duration", size).withColumn("batch", F.lit(batch))
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(os.path.join(folder, "timing_sketches"))


def registered(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("job bigint, name string, sketch binary, batch int").parquet(os.path.join(folder, "timing_sketches"))


def merged_percentiles(stored: DataFrame, group: list[str], points: dict[str, float]) -> DataFrame:
    """``n`` and a column for each point, per group, from the sketches alone."""
    merged = stored.groupBy(*group).agg(F.expr("kll_merge_agg_double(sketch)").alias("_sketch"))
    return merged.select(*group, F.expr("kll_sketch_get_n_double(_sketch)").alias("n"), *[
        F.expr(f"kll_sketch_get_quantile_double(_sketch, {point}D)").alias(name) for name, point in points.items()])
