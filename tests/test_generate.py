"""Generated tables: draws, invariants, steps, refresh sets."""

import pytest
from pyspark.sql import functions as F

from tradewind.functions import words as W
from tradewind.functions.draws import MODULUS, MULTIPLIER, jump, sparse_key
from tradewind.functions.text import pool
from tradewind.operators import quality, refresh
from tradewind.operators.warehouse import load_step
from tradewind.schema import TABLES
from tradewind.sources.generate import Generator
from tradewind.sources.tables import Catalog


def test_jump_equals_stepping(spark):
    value = 1171034773
    for row in spark.range(1, 3000).select(jump(1171034773, F.col("id")).alias("v")).collect():
        value = value * MULTIPLIER % MODULUS
        assert row.v == value


def test_jump_reaches_far(spark):
    far = 92 * 10 ** 12 + 5
    got = spark.range(1).select(jump(7, F.lit(far)).alias("v")).first().v
    assert got == 7 * pow(MULTIPLIER, far, MODULUS) % MODULUS


def test_sparse_keys(spark):
    got = spark.range(1, 33).select(sparse_key(F.col("id")).alias("a"),
                                    sparse_key(F.col("id"), 1).alias("b")).collect()
    assert [r.a for r in got][:9] == [1, 2, 3, 4, 5, 6, 7, 32, 33]
    assert not {r.a for r in got} & {r.b for r in got}


def test_pool_is_fixed_text():
    assert pool(2000) == pool(4000)[:2000] and len(pool(2000)) == 2000
    assert len(W.COLOURS) == 92 and len(W.part_types()) == 150 and len(W.containers()) == 40


def test_known_rows_at_scale(spark):
    """Published counts and amounts of the first orders."""
    generator = Generator(spark, 0.01)
    first = generator.orders().orderBy("o_orderkey").first()
    assert (first.o_custkey, first.o_orderstatus, first.o_totalprice) == (370, "O", 172799.49)
    assert generator.lineitem().count() == 60175


def violations(catalog):
    found = []
    keys = quality.primary_keys(catalog).filter("repeated_keys > 0 or null_keys > 0")
    found += [tuple(r) for r in keys.collect()]
    found += [tuple(r) for r in quality.foreign_keys(catalog).filter("orphan_rows > 0").collect()]
    found += [tuple(r) for r in quality.not_null(catalog).filter("nulls > 0").collect()]
    found += [tuple(r) for r in quality.lengths(catalog).filter("too_long > 0").collect()]
    found += [tuple(r) for r in quality.domains(catalog).filter("below + above > 0").collect()]
    found += [tuple(r) for r in quality.consistency(catalog).filter("violations > 0").collect()]
    return found


def test_invariants(spark, generated):
    assert violations(Catalog(spark, generated)) == []


@pytest.mark.parametrize("scale", [0.001, 0.01])
def test_steps_hold_the_invariants_together(spark, tmp_path, scale):
    for step in (1, 2, 3, 4, 4):  # the last step is loaded twice and must count once
        load_step(Generator(spark, scale, children=4, step=step), str(tmp_path))
    catalog = Catalog(spark, str(tmp_path))
    whole = quality.cardinalities(Catalog(spark, "")
                                  .with_tables(**{n: Generator(spark, scale).table(n) for n in TABLES}))
    stepped = quality.cardinalities(catalog).first().asDict()
    expected = whole.first().asDict()
    for name in ("customer", "orders", "lineitems", "part", "supplier", "nation", "region"):
        assert stepped[name] == expected[name], name
    assert violations(catalog) == []


def test_orders_need_no_shuffle(spark):
    plan = Generator(spark, 0.001).orders()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_customer_thirds_never_order(spark):
    assert Generator(spark, 0.01).orders().filter("o_custkey % 3 = 0").count() == 0


def test_supplier_remarks(spark):
    """About ten of 10,000 suppliers, half complaints, and lengths unchanged."""
    generator = Generator(spark, 10)
    suppliers = generator.supplier()
    complaints = suppliers.filter("s_comment like '%Customer%Complaints%'").count()
    praise = suppliers.filter("s_comment like '%Customer%Recommends%'").count()
    assert 20 < complaints < 80 and 20 < praise < 80
    assert suppliers.agg(F.max(F.length("s_comment"))).first()[0] <= 101


def test_refresh_keys_are_new_and_old(spark):
    generator = Generator(spark, 0.01)
    keys = generator.orders().select("o_orderkey")
    fresh = generator.refresh_rows(1)
    assert fresh.count() == 15
    assert keys.join(fresh.select(F.col("key").alias("o_orderkey")), "o_orderkey").count() == 0
    assert keys.join(generator.deleted_keys(1), "o_orderkey").count() == 15


def test_refresh_pair_changes_counts_by_known_amounts(spark):
    generator = Generator(spark, 0.01)
    base, rows = Catalog(spark, "").with_tables(
        orders=generator.orders(), lineitem=generator.lineitem()), generator.refresh_rows(2)
    grown = refresh.insert_orders(base.orders, generator.orders(rows))
    assert grown.count() == 15015
    left = refresh.delete_orders(grown, generator.deleted_keys(2), "o_orderkey")
    assert left.count() == 15000
    lines = refresh.delete_orders(
        refresh.insert_orders(base.lineitem, generator.lineitem(rows)),
        generator.deleted_keys(2), "l_orderkey")
    orphans = lines.join(left, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").count()
    assert orphans == 0
