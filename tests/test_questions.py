"""Edge cases of the questions, on small tables made for them."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.plans import params
from tradewind.plans.queries import QUERIES, months_after
from tradewind.plans.variants import BASE_OF, VARIANTS
from tradewind.sources.filled import FilledCatalog
from tradewind.sources.tables import Catalog


def rows(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.mark.parametrize("name", list(QUERIES))
def test_defaults_run_on_generated_tables(spark, generated, name):
    result = QUERIES[name](Catalog(spark, generated), **params.DEFAULTS[name])
    result.collect()


@pytest.mark.parametrize("name", list(VARIANTS))
def test_variants_equal_their_base(spark, generated, name):
    catalog, base = Catalog(spark, generated), BASE_OF[name]
    values = params.DEFAULTS[base]
    assert rows(VARIANTS[name](catalog, **values)) == rows(QUERIES[base](catalog, **values))


@pytest.mark.parametrize("name", list(QUERIES))
def test_random_parameters_fit_the_question(spark, small, name):
    values = params.draw(name, random.Random(7), 0.01)
    assert set(values) == set(params.DEFAULTS[name])
    QUERIES[name](FilledCatalog(spark, small), **values).schema


def test_stock_fraction_shrinks_with_scale():
    assert params.scaled_defaults(100)["q11"]["fraction"] == Decimal("0.0000010000")


def test_months_after_crosses_years():
    assert months_after(date(1996, 11, 1), 3) == date(1997, 2, 1)
    assert months_after(date(1996, 1, 1), 12) == date(1997, 1, 1)


def test_no_qualifying_line_gives_one_null(spark, small):
    catalog = FilledCatalog(spark, small)
    nothing = {"start": date(1950, 1, 1), "discount": Decimal("0.06"), "quantity": 24}
    assert rows(QUERIES["q06"](catalog, **nothing)) == [(None,)]
    assert rows(QUERIES["q14"](catalog, start=date(1950, 1, 1))) == [(None,)]


def test_top_supplier_keeps_ties(spark, small):
    catalog = FilledCatalog(spark, small)
    line = catalog.lineitem.limit(1).withColumn("l_shipdate", F.lit(date(1996, 2, 1)))
    twice = line.withColumn("l_suppkey", F.lit(1).cast("bigint")).unionByName(
        line.withColumn("l_suppkey", F.lit(3).cast("bigint")))
    got = rows(QUERIES["q15"](catalog.with_tables(lineitem=twice), start=date(1996, 1, 1)))
    assert [r[0] for r in got] == [1, 3] and got[0][4] == got[1][4]


def test_null_among_blamed_suppliers_rejects_all(spark, small):
    catalog = FilledCatalog(spark, small)
    unknown = catalog.supplier.limit(1).withColumns({
        "s_suppkey": F.lit(None).cast("bigint"), "s_comment": F.lit("Customer Complaints")})
    values = params.TEST_VALUES["q16"]
    assert rows(QUERIES["q16"](catalog, **values))
    holed = catalog.with_tables(supplier=catalog.supplier.unionByName(unknown))
    assert rows(QUERIES["q16"](holed, **values)) == []


def test_ties_at_the_cut_follow_the_key(spark, small):
    catalog = FilledCatalog(spark, small)
    same = catalog.lineitem.withColumns({
        "l_extendedprice": F.lit(100.0), "l_discount": F.lit(0.0)}).dropDuplicates(["l_orderkey"])
    got = rows(QUERIES["q03"](catalog.with_tables(lineitem=same), **params.TEST_VALUES["q03"]))
    keys = [(r[2], r[0]) for r in got]
    assert keys == sorted(keys)


def test_money_is_whole_cents(spark, small):
    """Cents by ``rint`` agree with the decimal reading of every stored amount."""
    from tradewind.functions.money import cents
    lines = FilledCatalog(spark, small).lineitem
    for name in ("l_extendedprice", "l_discount", "l_tax", "l_quantity"):
        exact = (F.col(name).cast("decimal(12,2)") * 100).cast("bigint")
        assert lines.filter(exact != F.expr(cents(name))).count() == 0


def test_exact_sum_survives_overflow_and_signs(spark):
    from tradewind.functions.money import exact_sum
    big = spark.range(4).select(F.lit(2 ** 62).cast("bigint").alias("v"))
    mixed = big.unionByName(spark.range(3).select(F.lit(-(2 ** 61) - 7).cast("bigint").alias("v")))
    got = mixed.agg(F.expr(exact_sum("v")).alias("s")).first().s
    assert int(got) == 4 * 2 ** 62 - 3 * (2 ** 61 + 7)


def test_cluster_settings_follow_the_data():
    from tradewind.session import cluster_settings
    big = cluster_settings(10 << 40, executors=1000, cores=8, memory_gb=64)
    assert big["spark.sql.shuffle.partitions"] == "81920"
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) == 256 << 20
    small = cluster_settings(1 << 30, executors=2, cores=4, memory_gb=4)
    assert small["spark.sql.shuffle.partitions"] == "16"
