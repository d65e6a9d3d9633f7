"""Hot keys are found in one pass and dealt over buckets; rows stay what they are."""

import uuid
from statistics import median

import pytest
from pyspark.sql import functions as F

from tradewind.operators import hot_keys


@pytest.fixture(scope="module")
def sides(spark):
    lines = spark.range(60000).select(
        F.when(F.col("id") % 10 < 3, 7).when(F.col("id") % 10 == 4, 11).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.col("id")).alias("l_key"),
        F.col("id").alias("l_number"))
    return lines, spark.range(50000).select(F.col("id").alias("o_key"), (F.col("id") % 5).alias("o_class"))


@pytest.fixture(scope="module")
def written(spark, sides, tmp_path_factory):
    name, folder = f"dealt_{uuid.uuid4().hex}", str(tmp_path_factory.mktemp("dealt"))
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    tables = (f"{name}.lines", f"{name}.orders")
    deals = hot_keys.write_dealt(*sides, ("l_key", "o_key"), tables, (f"{folder}/l", f"{folder}/o"), 16)
    yield tables, deals
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_hot_keys_are_found(spark, sides):
    found = {r.item: r["count"] for r in hot_keys.heavy_hitters(sides[0], "l_key", 32).collect()}
    assert abs(found[7] - 18000) < 600 and abs(found[11] - 6000) < 600


def test_no_bucket_holds_twice_the_median(spark, written):
    (lines, _), deals = written
    assert set(deals) == {7, 11} and len(deals[7]) == 16
    sizes = [r["count"] for r in spark.table(lines).filter("l_key is not null").groupBy(F.pmod(F.hash("l_key", "deal"), F.lit(16)).alias("b")).count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * median(sizes)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_equal_the_plain_join_without_a_shuffle(spark, sides, written, how):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = hot_keys.dealt_join(spark, written[0], ("l_key", "o_key"), how)
        plan = got._jdf.queryExecution().executedPlan().toString()
        want = sides[0].join(sides[1], F.col("l_key") == F.col("o_key"), how)
        assert "Exchange" not in plan
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_other_joins_are_refused(spark, written):
    with pytest.raises(ValueError):
        hot_keys.dealt_join(spark, written[0], ("l_key", "o_key"), "right")


def test_even_keys_are_left_alone(spark):
    even = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert hot_keys.hot_deals(even, "k", 8) == {}
    assert hot_keys.hot_deals(even.filter("false"), "k", 8) == {}
    assert hot_keys.dealt(even, "k", {}).filter("deal <> 0").isEmpty()
