"""Histograms change how a filter on a skewed column is planned."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tradewind.operators import warehouse

SETTINGS = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "200000", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def database(spark, tmp_path):
    name = f"histograms_{uuid.uuid4().hex}"
    before = {key: spark.conf.get(key) for key in SETTINGS}
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}'")
    # Nearly all values lie below 10, the greatest is 100,000.
    spark.range(100_000).select(F.col("id").alias("k"), F.when(F.col("id") < 100, F.col("id") * 1000).otherwise(F.col("id") % 10).alias("v")).write.saveAsTable(f"{name}.skewed")
    spark.range(40_000).select(F.col("id").alias("j"), (F.col("id") % 100).alias("w")).write.saveAsTable(f"{name}.plain")
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield name
    for key, value in before.items():
        spark.conf.set(key, value)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def plan(spark, database):
    joined = spark.table(f"{database}.skewed").filter("v > 1000").join(spark.table(f"{database}.plain"), F.col("k") == F.col("j"))
    return joined._jdf.queryExecution().executedPlan().toString(), joined.count()


def test_a_skewed_filter_changes_the_join(spark, database):
    tables = ["skewed", "plain"]
    warehouse.analyze_tables(spark, database, tables)
    flat, rows = plan(spark, database)
    warehouse.analyze_tables(spark, database, tables, bins=254)
    informed, again = plan(spark, database)
    assert rows == again == 98
    assert "BroadcastHashJoin" not in flat and re.search(r"BroadcastHashJoin \[k#\d+L\], \[j#\d+L\], Inner, BuildLeft", informed)
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"
