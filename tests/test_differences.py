"""Two loads that differ in single cells are told apart by reading few nodes."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators import differences as D
from tradewind.sources.generate import Generator


@pytest.fixture(scope="module")
def orders(spark):
    return Generator(spark, 0.01).orders().persist()


def compare(spark, a, b, folder):
    trees = [f"{folder}/{n}" for n in ("a", "b")]
    levels = tuple(D.build_tree(rows, "orders", tree) for rows, tree in zip((a, b), trees))
    found = D.differing_leaves(spark, *trees, levels)
    rows = {r.o_orderkey: (r.in_first, r.in_second) for r in D.differing_rows(a, b, "orders", found.leaves).collect()}
    return found, rows


def test_one_changed_cell_reads_few_nodes(spark, orders, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "LEAF_BITS", 6)
    key = orders.filter("o_orderkey > 20000").agg(F.min("o_orderkey")).first()[0]
    other = orders.withColumn("o_clerk", F.when(F.col("o_orderkey") == key, "x").otherwise(F.col("o_clerk"))).repartition(3)
    found, rows = compare(spark, orders, other, tmp_path)
    assert rows == {key: (1, 1)} and [r.node for r in found.leaves.collect()] == [key >> D.LEAF_BITS]
    leaves = orders.select(D.leaf_of("orders")).distinct().count()
    assert found.nodes_read <= 4 * (1 << D.FAN_BITS) < leaves


def test_equal_loads_read_the_root(spark, orders, tmp_path):
    found, rows = compare(spark, orders, orders.repartition(5), tmp_path)
    assert rows == {} and found.nodes_read == 1


def test_rows_lost_gained_doubled_and_without_key(spark, orders, tmp_path):
    keys = [r[0] for r in orders.select("o_orderkey").orderBy("o_orderkey").take(9)]
    gained = orders.filter(F.col("o_orderkey") == keys[1]).withColumn("o_orderkey", F.lit(-7).cast("bigint"))
    holed = gained.withColumn("o_orderkey", F.lit(None).cast("bigint"))
    far = gained.withColumn("o_orderkey", F.lit(1 << 40))
    other = orders.filter(F.col("o_orderkey") != keys[2]).unionByName(orders.filter(F.col("o_orderkey") == keys[3])).unionByName(gained).unionByName(holed).unionByName(far)
    _, rows = compare(spark, orders, other, tmp_path)
    assert rows == {keys[2]: (1, 0), keys[3]: (1, 2), -7: (0, 1), None: (0, 1), 1 << 40: (0, 1)}


def test_everything_differs_and_empty_tables(spark, orders, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "NAMED", 2)
    few = orders.filter("o_orderkey < 9000")
    _, rows = compare(spark, few, few.withColumn("o_shippriority", F.lit(1)), tmp_path / "x")
    assert len(rows) == few.count() and set(rows.values()) == {(1, 1)}
    _, rows = compare(spark, few.limit(0), few.limit(0), tmp_path / "y")
    assert rows == {}
    _, rows = compare(spark, few.limit(0), few, tmp_path / "z")
    assert len(rows) == few.count()
