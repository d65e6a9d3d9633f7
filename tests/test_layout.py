"""The Z-ordered layout keeps all rows, and files cover small boxes in every column."""

import random

from pyspark.sql import functions as F

from tradewind.operators import layout, warehouse
from tradewind.sources.filled import filled_catalog

COLUMNS = ["l_shipdate", "l_discount", "l_quantity"]


def test_interleaving_by_hand(spark):
    rows = [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (2, 0, 3), (3, 3, 3)]
    frame = spark.createDataFrame(rows, "a int, b int, c int")
    got = frame.select("a", "b", "c", layout.interleaved([F.col("a"), F.col("b"), F.col("c")]).alias("z")).collect()
    assert {tuple(r)[:3]: r.z for r in got} == {(0, 0, 0): 0, (1, 0, 0): 4, (0, 1, 0): 2, (0, 0, 1): 1, (2, 0, 3): 0b101001, (3, 3, 3): 63}


def test_rank_counts_bounds(spark):
    draw = random.Random(1)
    bounds = sorted(draw.choice([draw.random(), 0.5]) for _ in range(1023))
    values = [draw.random() for _ in range(200)] + [0.5, -1.0, 2.0, bounds[0], bounds[-1], None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = frame.select("v", layout.rank(F.col("v"), bounds).alias("n")).collect()
    assert all(r.n == (0 if r.v is None else sum(b <= r.v for b in bounds)) for r in got)


def read_rows(boxes):
    """Rows of the files that a filter on discount and quantity alone cannot skip."""
    return sum(r.rows for r in boxes.collect() if r.l_discount_low <= 0.03 and r.l_discount_high >= 0.02 and r.l_quantity_low < 10)


def test_filters_on_later_columns_read_less(spark, tmp_path):
    lines = filled_catalog(spark, "/root/testdata/sf0.01").lineitem
    ordered = layout.write_zordered(lines, str(tmp_path / "z"), "lineitem", 64)
    plain = warehouse.SORT_KEYS["lineitem"] + ["l_orderkey", "l_linenumber"]
    sorted_path = str(tmp_path / "sorted")
    lines.repartitionByRange(64, *plain).sortWithinPartitions(*plain).write.parquet(sorted_path)
    z, flat = spark.read.parquet(ordered), spark.read.parquet(sorted_path)
    total = lines.count()
    before, after = (read_rows(layout.boxes(f, COLUMNS)) for f in (flat, z))
    assert before > 0.9 * total and after < 0.4 * total
    day = lambda boxes: sum(r.rows for r in boxes.collect() if str(r.l_shipdate_low) <= "1997-03-31" and str(r.l_shipdate_high) >= "1997-01-01")
    assert day(layout.boxes(z, COLUMNS)) < 0.5 * total
    assert z.exceptAll(lines).isEmpty() and z.count() == total


def test_one_value_and_nulls(spark, tmp_path):
    rows = spark.range(500).selectExpr("id as o_orderkey", "id as o_custkey", "'F' as o_orderstatus", "cast(null as double) as o_totalprice",
                                       "date'1996-01-01' as o_orderdate")
    path = layout.write_zordered(rows, str(tmp_path), "orders", 4)
    back = spark.read.parquet(path)
    assert back.count() == 500 and layout.boxes(back, ["o_orderkey"]).count() == 4   # spread by the key


def test_empty_table(spark, tmp_path):
    rows = spark.range(0).selectExpr("id as o_orderkey", "cast(id as double) as o_totalprice", "date'1996-01-01' as o_orderdate")
    layout.write_zordered(rows, str(tmp_path), "orders", 4)
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "orders")).count() == 0
