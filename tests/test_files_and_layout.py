"""Flat files, checks on broken rows, layouts and plans."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewind.operators import quality, warehouse
from tradewind.plans import params
from tradewind.plans.queries import QUERIES
from tradewind.plans.variants import VARIANTS
from tradewind.registry import all_queries
from tradewind.sources import flatfile
from tradewind.sources.generate import Generator
from tradewind.sources.filled import FilledCatalog
from tradewind.sources.tables import Catalog
from tradewind.sources.tracking import read_logs


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_flat_lines_with_and_without_last_separator(spark, tmp_path):
    file = tmp_path / "supplier.tbl"
    file.write_text("1|Supplier#1|addr|17|27-1|-12.05|fine|\n2|Supplier#2||3|13-2|0.50|\n")
    got = flatfile.read_pipe(spark, str(file), "supplier").orderBy("s_suppkey").collect()
    assert (got[0].s_acctbal, got[0].s_comment) == (-12.05, "fine")
    assert (got[1].s_acctbal, got[1].s_address, got[1].s_comment) == (0.5, "", "")


@pytest.mark.parametrize("write, read", [(flatfile.write_pipe, flatfile.read_pipe),
                                         (flatfile.write_tabs, flatfile.read_tabs)])
def test_flat_files_round_trip(spark, tmp_path, write, read):
    generator = Generator(spark, 0.001)
    for name in ("orders", "customer", "nation"):
        path = write(generator.table(name), str(tmp_path), name)
        write(generator.table(name), str(tmp_path), name)  # a repeated step replaces itself
        back = read(spark, path, name)
        assert back.exceptAll(generator.table(name)).count() == 0
        assert back.count() == generator.table(name).count()


def test_flat_text_form(spark, tmp_path):
    line = Generator(spark, 0.001).orders().orderBy("o_orderkey").limit(1)
    path = flatfile.write_pipe(line, str(tmp_path), "orders", step=3)
    text = spark.read.text(path).first().value
    fields = text.split("|")
    assert len(fields) == 9 and fields[4].count("-") == 2 and fields[3].split(".")[1].isdigit()
    assert (tmp_path / "orders.tbl" / "step=3").exists()


def test_checks_find_one_of_each(spark, generated):
    good = Catalog(spark, generated)
    odd = good.nation.limit(1)
    nation = good.nation.unionByName(odd).unionByName(
        odd.withColumns({"n_nationkey": F.lit(99), "n_regionkey": F.lit(7),
                         "n_name": F.lit("x" * 26)})).unionByName(
        odd.withColumns({"n_nationkey": F.lit(98), "n_name": F.lit(None).cast("string")}))
    bad = good.with_tables(nation=nation)
    keys = {r.table_name: r for r in quality.primary_keys(bad).collect()}
    assert (keys["nation"].repeated_keys, keys["nation"].repeated_rows) == (1, 2)
    orphans = {r.constraint_name: r.orphan_rows for r in quality.foreign_keys(bad).collect()}
    assert orphans["nation_region"] == 1 and sum(orphans.values()) == 1
    nulls = {(r.table_name, r.column_name): r.nulls for r in quality.not_null(bad).collect()}
    assert nulls[("nation", "n_name")] == 1 and sum(nulls.values()) == 1
    long = quality.lengths(bad).filter("too_long > 0").collect()
    assert [(r.column_name, r.longest) for r in long] == [("n_name", 26)]
    outside = quality.domains(bad).filter("below + above > 0").collect()
    assert {r.column_name for r in outside} == {"n_nationkey", "n_regionkey"}


def test_bucketed_tables_join_without_shuffle(spark, small, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS layout LOCATION '{tmp_path}/db'")
    catalog = FilledCatalog(spark, small)
    for name in ("orders", "lineitem"):
        warehouse.write_bucketed(getattr(catalog, name), f"layout.{name}",
                                 warehouse.BUCKET_KEYS[name], f"{tmp_path}/{name}", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("layout.orders").join(
            spark.table("layout.lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        assert "Exchange" not in physical(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_are_kept_for_a_hot_key(spark, small, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS hot LOCATION '{tmp_path}/db'")
    lines = FilledCatalog(spark, small).lineitem.withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") <= 3, 1).otherwise(F.col("l_orderkey")))
    warehouse.write_bucketed(lines, "hot.lineitem", ["l_orderkey", "l_linenumber"], f"{tmp_path}/lines", 16)
    assert spark.table("hot.lineitem").count() == lines.count()
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED hot.lineitem").collect()}
    assert described["Num Buckets"] == "16"
    found = warehouse.hottest_share(lines, "l_orderkey").first()
    assert found.rows == lines.count() and found.hottest == lines.filter("l_orderkey = 1").count()


def test_bucket_count_follows_the_bytes():
    assert (warehouse.buckets_for(1), warehouse.buckets_for(100 << 40)) == (1, 409600)


def test_core_catalog_invents_nothing(spark, small):
    with pytest.raises(ValueError):
        Catalog(spark, small).lineitem
    with pytest.raises(FileNotFoundError):
        Catalog(spark, small).partsupp


def test_stored_types_stay_and_one_word_types_grow(spark, tmp_path, small):
    part = spark.read.parquet(f"{small}/part.parquet")
    part.limit(1).withColumn("p_type", F.lit("ECONOMY ANODIZED STEEL")).write.parquet(f"{tmp_path}/part")
    part.orderBy("p_partkey").limit(1).write.mode("append").parquet(f"{tmp_path}/part")
    types = sorted(r.p_type for r in FilledCatalog(spark, str(tmp_path)).part.collect())
    assert "ECONOMY ANODIZED STEEL" in types and all(len(t.split()) == 3 for t in types)


def test_registered_queries_see_a_folder_grow(spark, small, tmp_path):
    customer = spark.read.parquet(f"{small}/customer.parquet")
    for size in (1, 2):
        customer.write.mode("append").parquet(f"{tmp_path}/customer")
        assert all_queries()["scan_table_customer"](spark, str(tmp_path)).count() == size * customer.count()


# Scans of lineitem in each question; partsupp is derived from it in the narrow folder.
LINE_SCANS = {"q02": 1, "q09": 2, "q11": 1, "q13": 0, "q16": 1, "q20": 2, "q22": 0}


@pytest.mark.parametrize("name", [*QUERIES, *VARIANTS])
def test_each_question_scans_lines_once(spark, small, name):
    frame = {**QUERIES, **VARIANTS}[name](FilledCatalog(spark, small), **params.TEST_VALUES[name[:3]])
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    scans = len(re.findall(r"FileScan parquet \[[^]]*l_", plan))
    assert scans <= LINE_SCANS.get(name[:3], 1), plan


def test_year_folders_are_pruned(spark, small, tmp_path):
    path = warehouse.write_clustered(FilledCatalog(spark, small).orders, str(tmp_path), "orders")
    one = spark.read.parquet(path).filter("year = 1996")
    assert "PartitionFilters: [isnotnull(year" in physical(one)
    assert one.filter(F.year("o_orderdate") != 1996).count() == 0


def test_date_filters_reach_the_scan(spark, small):
    revenue = QUERIES["q06"](FilledCatalog(spark, small), **params.TEST_VALUES["q06"])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = revenue._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in plan
    assert "GreaterThanOrEqual(l_discount,0.05)" in plan and "LessThan(l_quantity,24.0)" in plan
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert read.count(":") == 4


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_have_no_cross_join(spark, small, name):
    plan = physical(QUERIES[name](FilledCatalog(spark, small), **params.TEST_VALUES[name]))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
