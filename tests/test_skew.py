"""One order, part, supplier and customer hold a third of all lines or orders.

The questions must still give whole results; the SQL of the other engine is
run over the same skewed files.
"""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from harness import compare, connect
from tradewind.plans.params import TEST_VALUES
from tradewind.plans.queries import QUERIES
from tradewind.registry import TITLES
from tradewind.sources.filled import FilledCatalog
from tradewind.sources.tables import read_columns


@pytest.fixture(scope="module")
def skewed(spark, small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    hot = lambda key, third: F.when(F.hash(*third) % 3 == 0, 7).otherwise(F.col(key)).cast("bigint")
    frames = {
        name: read_columns(spark, small, name)
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    line = ["l_extendedprice", "l_orderkey", "l_linenumber"]
    frames["lineitem"] = frames["lineitem"].withColumns({
        "l_partkey": hot("l_partkey", line), "l_suppkey": hot("l_suppkey", line[::-1]),
        "l_orderkey": hot("l_orderkey", line[:2])})
    frames["orders"] = frames["orders"].withColumn(
        "o_custkey", hot("o_custkey", ["o_totalprice", "o_orderkey"]))
    for name, frame in frames.items():
        frame.coalesce(1).toPandas().to_parquet(folder / f"{name}.parquet", index=False,
                                                coerce_timestamps="us")
    return str(folder)


@pytest.mark.parametrize("name", [f"{q}_{t}" for q, t in TITLES.items()] + [
    "check_primary_keys", "check_foreign_keys", "check_consistency", "segmented_refresh",
    "colocated_join"])
def test_whole_results_under_skew(spark, skewed, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    try:
        good, note = compare(spark, connect(skewed), skewed, entry_module.queries()[name],
                             entry_module.oracle_sql()[name])
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold",
                    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                    "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(key)
    assert good, note


@pytest.mark.parametrize("name", ["q17", "q18", "q20"])
def test_lines_are_summed_before_they_are_shuffled(spark, small, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = QUERIES[name](FilledCatalog(spark, small), **TEST_VALUES[name])
        plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [at for at, line in enumerate(plan) if re.search(r"FileScan parquet \[[^]]*l_quantity", line)]
    assert scans
    for at in scans:
        shuffle = max(i for i in range(at) if " Exchange hashpartitioning" in plan[i])
        assert any("partial_" in line for line in plan[shuffle:at]), "\n".join(plan)
