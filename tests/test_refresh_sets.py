"""The sets that the registered refresh jobs make of the given orders."""

from collections import Counter

import pytest

from tradewind import showcase
from tradewind.sources.filled import FilledCatalog

BLOCK = 1 << 20
KEYS = [None] * 3 + [k * (BLOCK // 700) for k in range(2500)] + [2996] * 2


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    orders = spark.createDataFrame([(k, "O") for k in KEYS], "o_orderkey bigint, o_orderstatus string")
    lines = spark.createDataFrame([(k, n) for k in KEYS for n in (1, 2)], "l_orderkey bigint, l_linenumber int")
    return FilledCatalog(spark, str(tmp_path_factory.mktemp("none"))).with_tables(orders=orders, lineitem=lines)


def want(count):
    size = max(len(KEYS) // 1000, 1)
    placed = [(k, at // size + 1) for at, k in enumerate(sorted(KEYS, key=lambda k: (k is not None, k)))]
    return Counter((k, u) for k, u in placed if k is not None and u <= count)


@pytest.mark.parametrize("count", [1, 3, 800, 2000])
def test_sets_are_runs_of_keys_nulls_counted_first(spark, base, count):
    members, orders, lines = showcase._sets(base, count)
    wanted, stored = want(count), Counter(KEYS)
    assert Counter((r.o_orderkey, r.refresh) for r in members.collect()) == wanted
    shift = max(k for k in KEYS if k is not None) + 1
    copies = Counter({(k + shift, u): n * stored[k] for (k, u), n in wanted.items()})
    assert Counter((r.o_orderkey, r.refresh) for r in orders.collect()) == copies
    assert Counter((r.l_orderkey, r.refresh) for r in lines.collect()) == Counter({k: 2 * n for k, n in copies.items()})


def test_no_orders_give_no_sets(spark, base):
    empty = base.with_tables(orders=base.orders.filter("false"), lineitem=base.lineitem.filter("false"))
    assert [f.count() for f in showcase._sets(empty, 2)] == [0, 0, 0]


def test_sets_are_found_once(spark, base):
    """Each write of a set reads the stored sets, where it moved both tables through a shuffle again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in showcase._sets(base, 2)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("Exchange" in plan for plan in plans)


def test_an_insert_set_reads_only_what_its_report_needs(spark, tmp_path):
    """Rules for columns that are not stored do not hold for keys below zero; the report asks for none of them."""
    spark.range(-2, 8).selectExpr("id as o_orderkey", "id as o_custkey", "'O' as o_orderstatus", "1.0D as o_totalprice", "date'1995-01-01' as o_orderdate",
                                  "'1-URGENT' as o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(-2, 8).selectExpr(
        "id as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber", "1.0D as l_quantity", "1.0D as l_extendedprice", "0.0D as l_discount",
        "0.0D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", "date'1995-01-01' as l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.table_name: (r.rows, r.key_sum) for r in showcase.insert_set(spark, str(tmp_path)).collect()}
    assert got == {"orders": (11, 25 + 6), "lineitem": (11, 25 + 6)}
