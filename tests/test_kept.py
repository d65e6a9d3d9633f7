"""Kept answers after every set equal the questions asked anew; a set's job looks at its own orders only."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators import compaction, kept, refresh
from tradewind.plans import queries as Q
from tradewind.sources.generate import Generator
from tradewind.sources.tables import Catalog

PARAMETERS = {"q01": {"days": 90}, "q13": {"first": "special", "second": "requests"}, "q18": {"quantity": 200}}
KEPT = {"q01": kept.pricing_summary(**PARAMETERS["q01"]), "q13": kept.customer_distribution(**PARAMETERS["q13"]),
        "q18": kept.large_orders(**PARAMETERS["q18"])}


@pytest.fixture(scope="module")
def base(spark):
    g = Generator(spark, 0.001)
    return Catalog(spark, "").with_tables(orders=g.orders().persist(), lineitem=g.lineitem().persist(), customer=g.customer().persist())


def write_sets(base, store, sets):
    for number, (gone, copied) in enumerate(sets, 1):
        moved = lambda rows, key: rows.filter(F.col(key).between(*copied)).withColumn(key, F.col(key) + 10000 * number)
        refresh.write_insert_set(base.spark, store, number, moved(base.orders, "o_orderkey"), moved(base.lineitem, "l_orderkey"))
        keys = base.orders.select("o_orderkey").unionByName(base.spark.range(10000, 50000).toDF("o_orderkey"))
        refresh.write_delete_set(base.spark, store, number, keys.filter(F.col("o_orderkey").between(*gone)).toDF("key"))


def same(base, store, state):
    now = base.with_tables(**{n: refresh.refreshed(base, store, n) for n in refresh.KEYS})
    for name, parameters in PARAMETERS.items():
        want = [tuple(r) for r in getattr(Q, name)(now, **parameters).collect()]
        assert [tuple(r) for r in kept.answer(base, state, name, KEPT).collect()] == want, name


# The second set deletes what the first brought, the third everything that is left of one range, and what it brings itself.
SETS = [((1, 900), (1000, 2500)), ((10900, 11800), (3000, 3200)), ((1000, 60000), (1, 3000)), ((2, 3), (2, 3))]


def test_answers_follow_the_sets(spark, base, tmp_path):
    store, state = str(tmp_path / "store"), str(tmp_path / "state")
    kept.begin(base, state, KEPT)
    same(base, store, state)
    write_sets(base, store, SETS[:2])
    assert kept.keep_up(base, store, state, KEPT) == [1, 2]
    same(base, store, state)
    write_sets(base, store, SETS)
    kept.apply_set(base, store, state, KEPT, 2)  # again
    assert kept.keep_up(base, store, state, KEPT) == [3, 4] and kept.keep_up(base, store, state, KEPT) == []
    same(base, store, state)
    same(base, store, kept.fold(spark, state, KEPT))


def test_sets_behind_a_version(spark, base, tmp_path):
    store, state, folder = (str(tmp_path / n) for n in ("store", "state", "versions"))
    kept.begin(base, state, KEPT)
    compaction.begin(base, folder, 4)
    write_sets(base, store, SETS[:2])
    compaction.compact(spark, folder, store, 1)
    kept.keep_up(base, store, state, KEPT)
    write_sets(base, store, SETS[:3])
    at = compaction.current(base, folder)
    kept.apply_set(at, store, state, KEPT, 3, after=1)
    same(base, store, state)


def test_a_set_looks_at_few_files(spark, base, tmp_path):
    store, folder = str(tmp_path / "store"), str(tmp_path / "versions")
    first = compaction.begin(base, folder, 50)
    at = compaction.current(base, folder)
    write_sets(base, store, [((100, 140), (5000, 5030))])
    keys = kept.touched_keys(spark, store, 1)
    ranges = kept.key_ranges(keys)
    assert sum(high - low for low, high in ranges) < 100
    rows = at.orders.filter(kept._in_ranges("o_orderkey", ranges))
    assert rows.select("_metadata.file_path").distinct().count() <= 2 < len(first.files["orders"])
    plan = kept.touched_rows(at, store, 0, 1, keys, ranges).orders._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_orderkey" in plan


def test_an_answer_reads_no_orders(spark, base, tmp_path):
    state = str(tmp_path / "state")
    kept.begin(base, state, KEPT)
    bare = Catalog(spark, "").with_tables(customer=base.customer)
    for name in KEPT:
        kept.answer(bare, state, name, KEPT).collect()


def test_whole_orders_are_not_moved_for_few_large_ones(spark, tmp_path):
    """The size of the lines promises far more large orders than there are; going by it, the join moved all orders."""
    orders, lines = (str(tmp_path / name) for name in ("orders", "lineitem"))
    spark.range(30000).selectExpr("id as o_orderkey", "id * 7 % 1000 as o_custkey", "date'1995-01-01' as o_orderdate", "id * 1.5D as o_totalprice").write.parquet(orders)
    spark.range(60000).selectExpr("id * 7919 % 30000 as l_orderkey", "cast(case when id < 3 then 300 else 1 end as decimal(12,2)) as l_quantity").write.parquet(lines)
    base = Catalog(spark, "").with_tables(orders=spark.read.parquet(orders), lineitem=spark.read.parquet(lines))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        rows = KEPT["q18"].change(None, base)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert {(r.o_orderkey, r.q) for r in rows.collect()} == {(0, 30100), (7919, 30100), (15838, 30100)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning(o_orderkey" not in plan
