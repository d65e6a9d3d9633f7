"""Refresh sets folded into files: only files with an affected row are written again."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators import compaction, refresh
from tradewind.sources.generate import Generator
from tradewind.sources.tables import Catalog


def lines_of(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def base(spark):
    generator = Generator(spark, 0.001)
    return Catalog(spark, "").with_tables(orders=generator.orders().persist(), lineitem=generator.lineitem().persist())


def orders_between(base, low, high):
    keys = base.orders.select("o_orderkey").filter(F.col("o_orderkey").between(low, high))
    return keys.toDF("key")


def inserts(base, low, high, shift):
    moved = lambda rows, key: rows.filter(F.col(key).between(low, high)).withColumn(key, F.col(key) + shift)
    return moved(base.orders, "o_orderkey"), moved(base.lineitem, "l_orderkey")


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "versions"), str(tmp_path / "store")


def same_as_merged(base, folder, store):
    now = compaction.current(base, folder, store)
    for name in refresh.KEYS:
        assert lines_of(getattr(now, name)) == lines_of(refresh.refreshed(base, store, name).select(getattr(now, name).columns)), name


def test_one_of_fifty_files_is_written_again(spark, base, places):
    folder, store = places
    first = compaction.begin(base, folder, 50)
    assert [len(f) for f in first.files.values()] == [50, 50]
    ranges = {f: compaction.rows_of(spark, [f], "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first() for f in first.files["orders"][:20]}
    target, (low, high) = sorted(ranges.items())[7]
    refresh.write_delete_set(spark, store, 1, orders_between(base, low, low + (high - low) // 2))
    report = {r.table_name: r for r in compaction.compact(spark, folder, store, 1).collect()}
    assert (report["orders"].rewritten, report["orders"].files_after) == (1, 50)
    assert 1 <= report["lineitem"].rewritten <= 2
    after = compaction.latest(spark, folder)
    assert set(first.files["orders"]) - set(after.files["orders"]) == {target}
    same_as_merged(base, folder, store)


def test_sets_of_all_kinds_equal_merge_on_read(spark, base, places):
    folder, store = places
    compaction.begin(base, folder, 8)
    for number, (gone, copied) in enumerate([((1, 200), (300, 400)), ((5000, 5100), (1, 90)), ((10300, 10350), (500, 600)), ((1000, 1100), (700, 720))], 1):
        orders, lines = inserts(base, *copied, 10000 * number)
        refresh.write_insert_set(spark, store, number, orders, lines)
        keys = orders_between(base, *gone)
        if number == 3:  # rows that set one brought
            keys = spark.range(gone[0], gone[1] + 1).toDF("key")
        refresh.write_delete_set(spark, store, number, keys)
    want = {name: lines_of(refresh.refreshed(base, store, name)) for name in refresh.KEYS}
    for upto in (1, 3):
        compaction.compact(spark, folder, store, upto)
        same_as_merged(base, folder, store)
    assert len(compaction.retire(spark, folder, store)) == 9
    gone = compaction.vacuum(spark, folder)
    assert gone and compaction.vacuum(spark, folder) == []
    now = compaction.current(base, folder, store)
    assert {name: lines_of(getattr(now, name)) for name in refresh.KEYS} == want
    compaction.compact(spark, folder, store, 4)
    now = compaction.current(base, folder)
    assert {name: lines_of(getattr(now, name)) for name in refresh.KEYS} == want


def test_applied_sets_and_late_ones_change_nothing(spark, base, places):
    folder, store = places
    compaction.begin(base, folder, 4)
    refresh.write_delete_set(spark, store, 2, orders_between(base, 1, 100))
    compaction.compact(spark, folder, store, 2)
    number = compaction.latest(spark, folder).number
    refresh.write_delete_set(spark, store, 1, orders_between(base, 200, 300))
    assert [r.rewritten for r in compaction.compact(spark, folder, store, 2).collect()] == [0, 0]
    assert compaction.latest(spark, folder).number == number
    assert compaction.current(base, folder, store).orders.filter("o_orderkey between 200 and 300").count() > 0


def test_a_version_without_its_mark_does_not_count(spark, base, places, tmp_path):
    folder, store = places
    first = compaction.begin(base, folder, 4)
    (tmp_path / "versions" / "versions" / "2").mkdir()
    assert compaction.latest(spark, folder) == first
    refresh.write_delete_set(spark, store, 1, orders_between(base, 1, 100))
    compaction.compact(spark, folder, store, 1)
    assert compaction.latest(spark, folder).number == 3
    same_as_merged(base, folder, store)


def test_everything_deleted(spark, base, places):
    folder, store = places
    compaction.begin(base, folder, 3)
    refresh.write_delete_set(spark, store, 1, base.orders.select("o_orderkey").toDF("key"))
    compaction.compact(spark, folder, store, 1)
    now = compaction.current(base, folder, store)
    assert now.orders.count() == 0 and now.lineitem.count() == 0


def test_only_keys_are_read_to_find_files(spark, base, places):
    folder, store = places
    first = compaction.begin(base, folder, 4)
    refresh.write_delete_set(spark, store, 1, orders_between(base, 1, 100))
    gone = refresh.latest_deletes(refresh.counting(spark, store, "deletes"))
    keys = compaction.rows_of(spark, first.files["lineitem"], "lineitem").filter("l_orderkey between 1 and 100").select("l_orderkey", "_metadata.file_path")
    plan = keys.join(gone, F.col("l_orderkey") == F.col("_gone"), "left_semi")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
