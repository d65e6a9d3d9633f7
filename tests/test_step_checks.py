"""Key checks of a step: exact violations, and only key columns of steps that matter are read."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators import step_checks as S
from tradewind.sources.generate import Generator


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Customers in step 1; orders and lines in three steps of their own key ranges."""
    folder, generator = str(tmp_path_factory.mktemp("steps")), Generator(spark, 0.001)
    S.append_remembered(generator.customer(), folder, "customer", 1)
    orders, lines = generator.orders(), generator.lineitem()
    for step, (low, high) in enumerate([(0, 2000), (2001, 4000), (4001, 10**6)], 1):
        S.append_remembered(orders.filter(F.col("o_orderkey").between(low, high)), folder, "orders", step)
        S.append_remembered(lines.filter(F.col("l_orderkey").between(low, high)), folder, "lineitem", step)
    return folder, orders, lines


def first(frame):
    return frame.first().asDict()


def test_clean_steps_have_no_violations(spark, loaded):
    folder, orders, _ = loaded
    for step in (1, 3):
        got = first(S.check_primary(spark, folder, "orders", step))
        assert got["repeated_inside"] == got["repeated_before"] == got["null_rows"] == 0 and got["keys"] > 0
    rows = {r.object_name: r for r in S.check_foreign(spark, folder, "orders", 3).collect()}
    assert rows["orders_customer"].orphan_keys == 0
    assert S.orphans(spark, folder, "lineitem", S.TABLES["lineitem"].foreign_keys[0], 2)[1].isEmpty()


def test_steps_of_other_ranges_are_not_asked(spark, loaded):
    folder, _, _ = loaded
    assert S.earlier_steps(spark, folder, "orders", 3, 4001, 10**6) == {}
    assert list(S.earlier_steps(spark, folder, "orders", 3, 100, 200)) == [1]
    assert list(S.earlier_steps(spark, folder, "orders", 2, 100, 9000)) == [1]


def test_planted_violations_are_exact(spark, loaded):
    folder, orders, lines = loaded
    old = orders.filter("o_orderkey < 300").limit(5)
    fresh = orders.filter("o_orderkey < 800").withColumn("o_orderkey", F.col("o_orderkey") + 10**7)
    doubled = fresh.limit(3)
    holed = fresh.limit(2).withColumn("o_orderkey", F.lit(None).cast("bigint"))
    lost = fresh.limit(4).withColumns({"o_orderkey": F.col("o_orderkey") + 10**7, "o_custkey": F.lit(999999).cast("bigint")})
    S.append_remembered(fresh.unionByName(old).unionByName(doubled).unionByName(holed).unionByName(lost), folder, "orders", 9)
    got = first(S.check_primary(spark, folder, "orders", 9))
    assert got == {"check_name": "primary key", "object_name": "orders", "keys": fresh.count() + 9, "null_rows": 2, "repeated_inside": 3, "repeated_before": 5}
    rows = {r.object_name: r for r in S.check_foreign(spark, folder, "orders", 9).collect()}
    assert (rows["orders_customer"].orphan_keys, rows["orders_customer"].orphan_rows) == (1, 4)
    # Lines of this step, of an earlier step, and of no order.
    parts = [lines.filter("l_orderkey between 300 and 400"), lines.filter("l_orderkey < 100").withColumn("l_orderkey", F.col("l_orderkey") + 10**7),
             lines.filter("l_orderkey < 50").withColumn("l_orderkey", F.col("l_orderkey") + 5 * 10**8)]
    S.append_remembered(parts[0].unionByName(parts[1]).unionByName(parts[2]), folder, "lineitem", 9)
    _, left = S.orphans(spark, folder, "lineitem", S.TABLES["lineitem"].foreign_keys[0], 9)
    assert left.agg(F.count("*"), F.sum("n")).first() == (parts[2].select("l_orderkey").distinct().count(), parts[2].count())
    got = first(S.check_primary(spark, folder, "lineitem", 9))
    assert got["repeated_before"] == parts[0].count() and got["repeated_inside"] == 0


def test_filters_hold_every_key_and_few_others(spark, loaded):
    folder, orders, _ = loaded
    keys = orders.filter("o_orderkey <= 2000").select("o_orderkey")
    steps = S.earlier_steps(spark, folder, "orders", 2, 0, 2000)
    assert S.held_by_filters(spark, folder, "orders", keys, ["o_orderkey"], steps).count() == keys.count()
    others = spark.range(10**6, 10**6 + 20000).toDF("o_orderkey")
    assert S.held_by_filters(spark, folder, "orders", others, ["o_orderkey"], steps).count() < 0.03 * 20000


def test_only_keys_are_read(spark, loaded):
    folder, _, lines = loaded
    rows = lines.filter("l_orderkey < 500").select("l_orderkey", "l_linenumber").distinct()
    plan = S.known_before(spark, folder, "lineitem", rows, ["l_orderkey", "l_linenumber"], 3)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:bigint>" in plan and "l_comment" not in plan.split("Physical Plan")[1]


def test_a_step_loaded_again_replaces_its_summary(spark, tmp_path):
    rows = lambda low, high: spark.range(low, high).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"))
    folder = str(tmp_path)
    S.append_remembered(rows(0, 100), folder, "orders", 1)
    S.append_remembered(rows(50, 60), folder, "orders", 1)
    S.append_remembered(rows(0, 55), folder, "orders", 2)
    assert first(S.check_primary(spark, folder, "orders", 2))["repeated_before"] == 5
    S.append_remembered(rows(0, 0), folder, "orders", 3)
    assert first(S.check_primary(spark, folder, "orders", 3))["keys"] == 0
