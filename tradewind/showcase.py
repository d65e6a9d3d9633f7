"""Registered forms of the loading, layout, refresh, generation and streaming jobs.

Each takes the given tables, runs the job over all of their rows, and returns a
report that SQL can confirm.  Intermediate files go to the shared scratch
folder.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import steps as S
from tradewind.functions import words as W
from tradewind.functions.draws import STREAMS, draw, jump, pick, positioned, sparse_key
from tradewind.functions.money import REVENUE, cents, exact_sum, money
from tradewind.functions.text import comment
from tradewind.operators import compaction, differences, hot_keys, kept, layout, quality, refresh, step_checks, warehouse
from tradewind.operators.joins import null_aware_anti
from tradewind.operators.ordered import BLOCK_BITS, id_block, last_block, row_numbers
from tradewind.plans import sweeps
from tradewind.plans.params import TEST_VALUES
from tradewind.schema import TABLES
from tradewind.session import scratch, stored
from tradewind.sources import flatfile
from tradewind.sources import tracking as TrackingSource
from tradewind.sources.generate import Generator, part_name
from tradewind.sources.filled import filled_catalog
from tradewind.sources.tables import Catalog, read_columns
from tradewind.streaming import jobs

col, lit = F.col, F.lit


# -- scans and files --------------------------------------------------------

def scan(name: str):
    return lambda spark, folder: getattr(filled_catalog(spark, folder), name)


def _lines_summary(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("rows"), F.expr(money(exact_sum(cents("l_extendedprice")), 2)).alias("price"),
             F.min("l_shipdate").alias("first_ship"), F.max("l_receiptdate").alias("last_receipt"),
             F.count_distinct("l_shipmode").alias("modes"),
             F.count(F.when(col("l_comment") == "", 1)).alias("blank_comments"))
        .orderBy("l_returnflag", "l_linestatus"))


def pipe_files(spark: SparkSession, folder: str) -> DataFrame:
    path = flatfile.write_pipe(filled_catalog(spark, folder).lineitem, scratch(spark, "pipe"), "lineitem")
    return _lines_summary(flatfile.read_pipe(spark, path, "lineitem"))


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a flat file by what is wrong with them: some are cut off, some have no number or no key."""
    path, key = scratch(spark, "flat"), col("l_orderkey") % 40
    fields = [F.when(key == 2, lit("many")).otherwise(col(c).cast("string")) if c == "l_quantity"
              else F.when(key == 3, lit("")).otherwise(col(c).cast("string")) if c == "l_orderkey"
              else F.coalesce(col(c).cast("string"), lit("")) for c in TABLES["lineitem"].column_names]
    line = F.concat_ws("|", *fields)
    filled_catalog(spark, folder).lineitem.select(F.when(key == 1, F.substring_index(line, "|", 9)).otherwise(F.concat(line, lit("|")))).write.text(path)
    good, rejects = flatfile.read_pipe_checked(spark, path, "lineitem")
    return rejects.groupBy("reason").count().unionByName(good.select(lit("good").alias("reason")).groupBy("reason").count()).select(
        "reason", col("count").alias("rows"))


def tab_files(spark: SparkSession, folder: str) -> DataFrame:
    path = flatfile.write_tabs(filled_catalog(spark, folder).lineitem, scratch(spark, "tabs"), "lineitem")
    return _lines_summary(flatfile.read_tabs(spark, path, "lineitem")
                          .withColumn("l_comment", F.coalesce("l_comment", lit(""))))


def dumped_jobs(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "dump")
    TrackingSource.write_dump(
        TrackingSource.from_events(read_columns(spark, folder, "events")), path)
    back = TrackingSource.read_dump(spark, path)
    counts = back.query.groupBy(col("job").alias("id")).agg(F.count("*").alias("queries"))
    return back.job.join(counts, "id", "left").select(
        "id", "run", "name", col("start").cast("timestamp_ntz").alias("start"), "duration",
        S.label(col("steps")).alias("steps"), F.coalesce("queries", lit(0)).alias("queries"))


# -- loading and layout -----------------------------------------------------

def _step_report(rows: DataFrame) -> DataFrame:
    return rows.groupBy("step").agg(
        F.count("*").alias("rows"), F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.expr(money(exact_sum(cents("o_totalprice")), 2)).alias("price")).orderBy("step")


def steps_appended(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "steps")
    stepped = warehouse.numbered_steps(filled_catalog(spark, folder).orders, "o_orderkey", 4)
    for step in (1, 2, 3, 4, 2):  # the second step is loaded again
        warehouse.append_step(stepped.filter(col("step") == step).drop("step"), path, "orders", step)
    return _step_report(spark.read.parquet(os.path.join(path, "orders")))


def step_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Key checks of the last of four steps; some of its lines name orders that do not exist, and pairs of order and number repeat across steps."""
    catalog, path = filled_catalog(spark, folder), scratch(spark, "step-keys")
    shift = catalog.orders.agg((F.max("o_orderkey") + 1).alias("n")).scalar()
    lost = (col("l_partkey") % 4 == 3) & (col("l_quantity") == 13)
    lines = catalog.lineitem.withColumn("l_orderkey", F.when(lost, col("l_orderkey") + shift).otherwise(col("l_orderkey")))
    steps = {"orders": (catalog.orders, col("o_orderkey") % 4), "lineitem": (lines, col("l_partkey") % 4), "partsupp": (catalog.partsupp, col("ps_partkey") % 4)}
    for name, (rows, part) in steps.items():
        for step in range(1, 5):
            step_checks.append_remembered(rows.filter(part == step - 1), path, name, step)
    primary = [step_checks.check_primary(spark, path, name, 4) for name in steps]
    report = reduce(DataFrame.unionByName, primary).select(
        "check_name", "object_name", "keys", col("repeated_inside").alias("violating_keys"), col("repeated_before").alias("earlier_keys"))
    foreign = step_checks.check_foreign(spark, path, "lineitem", 4)
    return report.unionByName(foreign.select(
        "check_name", "object_name", "keys", col("orphan_keys").alias("violating_keys"), lit(0).cast("bigint").alias("earlier_keys")))


def located_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that another load has changed, lost or gained, found from the digest trees of both."""
    orders, path = filled_catalog(spark, folder).orders, scratch(spark, "trees")
    key = col("o_orderkey")
    other = orders.filter(key % 1499 != 4).withColumn(
        "o_totalprice", F.when(key % 1499 == 3, col("o_totalprice") + 1).otherwise(col("o_totalprice")))
    other = other.unionByName(orders.filter(key % 1499 == 5).withColumn("o_orderkey", -key - 1))
    trees = [os.path.join(path, name) for name in ("first", "second")]
    levels = tuple(differences.build_tree(rows, "orders", tree) for rows, tree in zip((orders, other), trees))
    found = differences.differing_leaves(spark, *trees, levels)
    return differences.differing_rows(orders, other, "orders", found.leaves)


def _database(spark: SparkSession, label: str) -> tuple[str, str]:
    path = scratch(spark, label)
    name = os.path.basename(path).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{path}'")
    return name, path


def loaded_tables(spark: SparkSession, folder: str) -> DataFrame:
    name, path = _database(spark, "loaded")
    return warehouse.initial_load(filled_catalog(spark, folder), name, path)


def dropped_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each table before it was dropped, and whether a table is left."""
    name, path = _database(spark, "dropped")
    warehouse.create_tables(filled_catalog(spark, folder), name, path)
    loaded = warehouse.Database(spark, name)
    counts = [getattr(loaded, t).agg(F.count("*").alias("rows")).select(lit(t).alias("table_name"), "rows") for t in TABLES]
    before = stored(reduce(DataFrame.unionByName, counts), "dropped-counts")
    warehouse.drop_tables(spark, name)
    left = spark.sql(f"SHOW TABLES IN {name}").select(col("tableName").alias("table_name"), lit(True).alias("there"))
    return before.join(left, "table_name", "left").select(
        "table_name", "rows", F.coalesce("there", lit(False)).alias("there"))


def analyzed_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts and key ranges as the statistics report them."""
    name, path = _database(spark, "analyzed")
    warehouse.create_tables(filled_catalog(spark, folder), name, path)
    warehouse.analyze_tables(spark, name)
    return warehouse.table_statistics(spark, name)


def cached_tables(spark: SparkSession, folder: str) -> DataFrame:
    name, path = _database(spark, "cached")
    warehouse.create_tables(filled_catalog(spark, folder), name, path)
    warehouse.warm_cache(spark, name, list(TABLES))
    counts = stored(quality.cardinalities(warehouse.Database(spark, name)), "cached-counts")
    warehouse.release_cache(spark, name, list(TABLES))
    return counts


def clustered_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per ship year and flag, read from a year-partitioned, sorted copy."""
    path = warehouse.write_clustered(
        filled_catalog(spark, folder).lineitem, scratch(spark, "layout"), "lineitem")
    return (spark.read.parquet(path).groupBy("year", "l_linestatus")
            .agg(F.count("*").alias("rows"),
                 F.expr(money(exact_sum(REVENUE), 4)).alias("revenue")))


def zordered_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by ship year of lines with certain discounts and quantities, whatever their date, read from a Z-ordered copy."""
    path = layout.write_zordered(filled_catalog(spark, folder).lineitem, scratch(spark, "zordered"), "lineitem")
    lines = spark.read.parquet(path).filter("l_discount between 0.02 and 0.03 and l_quantity < 10")
    return lines.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count("*").alias("rows"), F.expr(money(exact_sum(REVENUE), 4)).alias("revenue"))


LINE_BYTES, OFFER_BYTES = 150, 160  # widths of a stored row of the larger table of each pair


def _bucketed(spark: SparkSession, folder: str, larger: str, smaller: str, width: int) -> str:
    """A database with a pair of tables bucketed alike; the rows of the larger one set the number of buckets."""
    name, path = _database(spark, f"bucketed-{larger}")
    catalog = filled_catalog(spark, folder)
    buckets = warehouse.buckets_for(getattr(catalog, larger).count() * width)
    for table in (larger, smaller):
        warehouse.write_bucketed(
            getattr(catalog, table), f"{name}.{table}", warehouse.BUCKET_KEYS[table],
            os.path.join(path, table), buckets)
    return name


def colocated_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Stock per brand, from parts and offers bucketed on the part key."""
    name = _bucketed(spark, folder, "partsupp", "part", OFFER_BYTES)
    stock = spark.table(f"{name}.partsupp").groupBy("ps_partkey").agg(
        F.sum("ps_availqty").alias("quantity"), F.count("*").alias("offers"))
    return (
        spark.table(f"{name}.part").join(stock, col("p_partkey") == col("ps_partkey"))
        .groupBy("p_brand").agg(F.sum("offers").alias("offers"), F.sum("quantity").alias("quantity")))


def colocated_join(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per order priority, from orders and lines bucketed on the order key."""
    name = _bucketed(spark, folder, "lineitem", "orders", LINE_BYTES)
    lines = (spark.table(f"{name}.lineitem").groupBy("l_orderkey")
             .agg(F.expr(exact_sum(REVENUE)).alias("units")))
    return (
        spark.table(f"{name}.orders").join(lines, col("o_orderkey") == col("l_orderkey"))
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("orders"), F.expr(money("sum(units)", 4)).alias("revenue")))


def dealt_join(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by order priority where three lines of ten belong to one order, from tables that deal it over the buckets."""
    name, path = _database(spark, "dealt")
    catalog = filled_catalog(spark, folder)
    first = catalog.orders.agg(F.min("o_orderkey").alias("n")).scalar()
    lines = catalog.lineitem.withColumn("l_orderkey", F.when(col("l_orderkey") % 10 < 3, first).otherwise(col("l_orderkey")))
    buckets = max(8, warehouse.buckets_for(lines.count() * LINE_BYTES))
    tables = (f"{name}.lineitem", f"{name}.orders")
    hot_keys.write_dealt(lines, catalog.orders, ("l_orderkey", "o_orderkey"), tables, (os.path.join(path, "lineitem"), os.path.join(path, "orders")), buckets)
    joined = hot_keys.dealt_join(spark, tables, ("l_orderkey", "o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("lines"), F.expr(money(exact_sum(REVENUE), 4)).alias("revenue"))


# -- joins and functions ----------------------------------------------------

def not_in_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """NOT IN against a clean list, a list with a null, and an empty list."""
    catalog = filled_catalog(spark, folder)
    orders = catalog.orders.select("o_orderkey", "o_custkey")
    buyers = catalog.customer.filter(col("c_mktsegment") == "BUILDING").select("c_custkey")
    holed = buyers.select(F.when(col("c_custkey") > 0, col("c_custkey")).alias("c_custkey"))
    holed = holed.unionByName(spark.range(1).select(lit(None).cast("bigint").alias("c_custkey")))
    cases = {"clean": buyers, "with_null": holed, "empty": buyers.filter(col("c_custkey") < 0)}
    frames = [null_aware_anti(orders, right, "o_custkey", "c_custkey")
              .agg(F.count("*").alias("rows")).select(lit(name).alias("case_name"), "rows")
              for name, right in cases.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def step_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Step texts of every kind, expanded; one row per event."""
    events = read_columns(spark, folder, "events")
    low, high = (col("event_id") % 50).cast("string"), (col("event_id") % 50 + 3).cast("string")
    kind = col("event_id") % 5
    text = (F.when(kind == 0, low).when(kind == 1, F.concat(low, lit(".."), high))
            .when(kind == 2, "x").when(kind == 3, "1..2..3")
            .otherwise(F.concat(high, lit(".."), low)))
    rows = events.select("event_id", text.alias("text"))
    steps = S.expand(col("text"))
    return rows.select("event_id", "text", F.array_join(steps, ",").alias("steps"),
                       S.last_scale(col("text"), 300, 100).alias("scale"))


# -- refresh ----------------------------------------------------------------

def _members(catalog: Catalog, count: int) -> DataFrame:
    """``o_orderkey, refresh``: set u has the u-th thousandth of the orders by key.

    Only keys of the blocks that the sets reach are numbered; what is stored is a thousandth of the keys for each set.
    """
    keys = catalog.orders.select("o_orderkey").withColumn("block", id_block("o_orderkey"))
    size = max(keys.count() // 1000, 1)
    last = last_block(keys, "block", count * size)
    if last is not None:  # keys without a value are counted as before all others
        keys = keys.filter(col("o_orderkey").isNull() | (col("o_orderkey") < (last + 1) << BLOCK_BITS))
    ranked = row_numbers(keys, [], "block", "o_orderkey", "row")
    return stored(ranked.select(
        "o_orderkey", (F.floor((col("row") - 1) / size) + 1).cast("int").alias("refresh")
    ).filter(col("refresh") <= count), "refresh-members")


def _set_rows(catalog: Catalog, count: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Refresh sets over the given orders: set u deletes the u-th thousandth of the
    orders by key, and inserts copies of them, with their lines, under new keys.

    The range of the members' keys reaches the scans, so that no join moves a table.
    """
    members = _members(catalog, count)
    low, high = members.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    near = lambda key: lit(False) if low is None else col(key).between(low, high)
    shift = catalog.orders.agg((F.max("o_orderkey") + 1).alias("n")).first().n
    orders = catalog.orders.filter(near("o_orderkey")).join(members, "o_orderkey").withColumn(
        "o_orderkey", col("o_orderkey") + lit(shift).cast("bigint"))
    lines = catalog.lineitem.filter(near("l_orderkey")).join(members, col("l_orderkey") == col("o_orderkey")).drop(
        "o_orderkey").withColumn("l_orderkey", col("l_orderkey") + lit(shift).cast("bigint"))
    return members, orders, lines


def _sets(catalog: Catalog, count: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Refresh sets that are written to a store, so all columns are needed: found once for all writes."""
    members, orders, lines = _set_rows(catalog, count)
    return members, stored(orders, "refresh-orders"), stored(lines, "refresh-lines")


def _status_report(orders: DataFrame, lines: DataFrame) -> DataFrame:
    def summary(rows, table, status, key):
        return rows.groupBy(col(status).alias("status")).agg(
            F.count("*").alias("rows"), F.sum(key).alias("key_sum")
        ).select(lit(table).alias("table_name"), "*")
    return summary(orders, "orders", "o_orderstatus", "o_orderkey").unionByName(
        summary(lines, "lineitem", "l_linestatus", "l_orderkey"))


def insert_set(spark: SparkSession, folder: str) -> DataFrame:
    catalog = filled_catalog(spark, folder)
    _, orders, lines = _set_rows(catalog, 1)
    return _status_report(
        refresh.insert_orders(catalog.orders, orders.select(*catalog.orders.columns)),
        refresh.insert_orders(catalog.lineitem, lines.select(*catalog.lineitem.columns)))


def delete_set(spark: SparkSession, folder: str) -> DataFrame:
    catalog = filled_catalog(spark, folder)
    members = _members(catalog, 1)
    return _status_report(refresh.delete_orders(catalog.orders, members, "o_orderkey"),
                          refresh.delete_orders(catalog.lineitem, members, "l_orderkey"))


def segmented_set(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as one set, cut into three segments together with their lines."""
    lines = refresh.segments(filled_catalog(spark, folder).lineitem, "l_orderkey", 3)
    return lines.groupBy("segment").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count("*").alias("lines"),
        F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key"))


def stored_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Two stored sets merged with the base; set two is written twice."""
    catalog, store = filled_catalog(spark, folder), scratch(spark, "refresh")
    members, orders, lines = _sets(catalog, 2)
    for number in (1, 2, 2):
        own = col("refresh") == number
        refresh.write_insert_set(
            spark, store, number, orders.filter(own).drop("refresh"),
            lines.filter(own).drop("refresh"))
        refresh.write_delete_set(spark, store, number, members.filter(own).drop("refresh"))
    return _status_report(refresh.refreshed(catalog, store, "orders"),
                          refresh.refreshed(catalog, store, "lineitem"))


def _write_sets(catalog: Catalog, store: str, count: int) -> None:
    members, orders, lines = _sets(catalog, count)
    for number in range(1, count + 1):
        own = col("refresh") == number
        refresh.write_insert_set(catalog.spark, store, number, orders.filter(own).drop("refresh"), lines.filter(own).drop("refresh"))
        refresh.write_delete_set(catalog.spark, store, number, members.filter(own).drop("refresh"))


def compacted_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Three stored sets: two are folded into the tables and retired, the third is merged with them."""
    catalog, store, versions = filled_catalog(spark, folder), scratch(spark, "refresh"), scratch(spark, "versions")
    _write_sets(catalog, store, 3)
    compaction.begin(catalog, versions)
    compaction.compact(spark, versions, store, 1)
    compaction.compact(spark, versions, store, 2)
    compaction.retire(spark, versions, store)
    compaction.vacuum(spark, versions)
    now = compaction.current(catalog, versions, store)
    return _status_report(now.orders, now.lineitem)


KEPT = {"q01": kept.pricing_summary(**TEST_VALUES["q01"]), "q13": kept.customer_distribution(**TEST_VALUES["q13"]),
        "q18": kept.large_orders(**TEST_VALUES["q18"])}


def kept_answer(name: str):
    """One question as it stands after three refresh sets, from its state."""
    def rows(spark: SparkSession, folder: str) -> DataFrame:
        catalog, store, state = filled_catalog(spark, folder), scratch(spark, "refresh"), scratch(spark, "kept")
        own = {name: KEPT[name]}
        _write_sets(catalog, store, 3)
        kept.begin(catalog, state, own)
        kept.keep_up(catalog, store, state, own)
        return kept.answer(catalog, state, name, own)
    return rows


# -- streaming --------------------------------------------------------------

def streamed_steps(spark: SparkSession, folder: str) -> DataFrame:
    orders = filled_catalog(spark, folder).orders
    landing, target, state = (scratch(spark, n) for n in ("landing", "ingested", "state"))
    (warehouse.numbered_steps(orders, "o_orderkey", 4)
     .write.partitionBy("step").parquet(landing))
    jobs.ingest_steps(spark, orders.schema, landing, target, state).awaitTermination()
    return _step_report(spark.read.parquet(target))


def streamed_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Two sets delivered by file: the first in two parts over two triggers, the second twice before
    one trigger and once more later."""
    catalog = filled_catalog(spark, folder)
    landing, store, state = (scratch(spark, n) for n in ("sets", "store", "state"))
    members, orders, lines = _sets(catalog, 2)
    deletes = members.select(col("o_orderkey").alias("key"), "refresh")
    schemas = (catalog.orders.schema, catalog.lineitem.schema)
    triggers = (  # (set, delivery, part of it) as they land before each trigger
        ((1, 1, 0), (2, 1, None), (2, 2, None)), ((1, 1, 1), (2, 3, None)))
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "deletes": "key"}
    for landed in triggers:
        for number, delivery, half in landed:
            for name, rows in (("orders", orders), ("lineitem", lines), ("deletes", deletes)):
                own = col("refresh") == number
                own = own if half is None else own & (col(keys[name]) % 2 == half)
                (rows.filter(own).withColumn("delivery", lit(delivery)).write.mode("append")
                 .partitionBy("refresh", "delivery").parquet(os.path.join(landing, name)))
        for query in jobs.apply_refresh_sets(spark, *schemas, landing, store, state):
            query.awaitTermination()
    return _status_report(refresh.refreshed(catalog, store, "orders"),
                          refresh.refreshed(catalog, store, "lineitem"))


def streamed_throughput(spark: SparkSession, folder: str) -> DataFrame:
    """Queries per minute over all events: the windows written by the stream and the open ones at its end."""
    target, state = scratch(spark, "windows"), scratch(spark, "state")
    schema = read_columns(spark, folder, "events").schema
    jobs.stream_throughput(spark, schema, folder, target, state,
                           pattern="events.parquet").awaitTermination()
    return jobs.all_windows(spark, schema, folder, target, pattern="events.parquet").orderBy("window_start")


def streamed_job_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of every user's events as a job: every third one short, with five-second intervals."""
    target, state = scratch(spark, "job-windows"), scratch(spark, "state")
    events = read_columns(spark, folder, "events")
    planned = F.when(col("job") % 3 == 0, 60).otherwise(3600)
    users = stored(events.select(col("user_id").alias("job")).distinct().withColumn("planned", planned), "planned-jobs")
    read = lambda rows: rows.select(col("user_id").alias("job"), col("event_type").alias("name"), "ts")
    given = (spark, events.schema, folder, users, read, "purchase", target)
    jobs.stream_job_windows(*given, state, pattern="events.parquet").awaitTermination()
    return jobs.job_reports(*given, pattern="events.parquet")


# -- sweeps -----------------------------------------------------------------

def swept_q06(spark: SparkSession, folder: str) -> DataFrame:
    return sweeps.sweep_q06(filled_catalog(spark, folder), sweeps.q06_parameters(spark))


def swept_q14(spark: SparkSession, folder: str) -> DataFrame:
    return sweeps.sweep_q14(filled_catalog(spark, folder), sweeps.q14_parameters(spark))


# -- generation, driven by the keys of the given tables ---------------------

def _numbers(spark: SparkSession, folder: str, table: str, key: str) -> DataFrame:
    return read_columns(spark, folder, table).select((col(key) + 1).alias("n"))


def draws(spark: SparkSession, folder: str) -> DataFrame:
    """For every order, a number drawn from its place in a stream."""
    rows = positioned(_numbers(spark, folder, "orders", "o_orderkey"), "n", "o_clerk")
    return rows.select("n", draw("o_clerk", 1, 1000).alias("value"))


def jumps(spark: SparkSession, folder: str) -> DataFrame:
    """For every order, the state that many draws ahead."""
    return _numbers(spark, folder, "orders", "o_orderkey").select(
        "n", jump(STREAMS["o_clerk"][0], col("n")).alias("state"))


def picks(spark: SparkSession, folder: str) -> DataFrame:
    """For every order, a noun chosen by weight."""
    rows = positioned(_numbers(spark, folder, "orders", "o_orderkey"), "n", "o_clerk")
    return rows.select("n", pick("o_clerk", W.NOUNS).alias("word"))


def names(spark: SparkSession, folder: str) -> DataFrame:
    """For every part, five distinct colour words."""
    rows = positioned(_numbers(spark, folder, "part", "p_partkey"), "n", "p_name")
    return rows.select("n", part_name().alias("name"))


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """For every order, a slice of the sentence pool."""
    rows = positioned(_numbers(spark, folder, "orders", "o_orderkey"), "n", "o_comment")
    return rows.select("n", comment("o_comment", 49).alias("text"))


def sparse_keys(spark: SparkSession, folder: str) -> DataFrame:
    n = col("n")
    return _numbers(spark, folder, "orders", "o_orderkey").select(
        n, sparse_key(n).alias("loaded_key"), sparse_key(n, 1).alias("refresh_key"))


def generated(table: str, source: str, key: str):
    def rows(spark: SparkSession, folder: str) -> DataFrame:
        numbers = _numbers(spark, folder, source, key)
        if table in ("orders", "lineitem"):
            numbers = numbers.withColumn("key", sparse_key(col("n")))
        return getattr(Generator(spark), table)(numbers)
    return rows


GENERATED = {
    "part": ("part", "p_partkey"), "partsupp": ("part", "p_partkey"),
    "supplier": ("supplier", "s_suppkey"), "customer": ("customer", "c_custkey"),
    "orders": ("orders", "o_orderkey"), "lineitem": ("orders", "o_orderkey"),
}

SHOWCASE = {
    **{f"scan_table_{name}": scan(name) for name in TABLES},
    "write_and_scan_flat_file": pipe_files,
    "flat_file_rejects": rejected_lines,
    "write_tab_copy": tab_files,
    "write_and_read_tab_dump": dumped_jobs,
    "load_step_append": steps_appended,
    "initial_load": loaded_tables,
    "check_step_keys": step_keys,
    "locate_differences": located_differences,
    "drop_tables": dropped_tables,
    "analyze_tables": analyzed_tables,
    "warm_cache": cached_tables,
    "cluster_layout": clustered_layout,
    "zorder_layout": zordered_layout,
    "colocated_join": colocated_join,
    "colocated_parts": colocated_parts,
    "colocated_hot_key": dealt_join,
    "null_aware_anti_join": not_in_with_nulls,
    "expand_step_range": step_ranges,
    "rf1_insert": insert_set,
    "rf2_delete": delete_set,
    "segmented_refresh": segmented_set,
    "stored_refresh_sets": stored_sets,
    "compact_refresh_sets": compacted_sets,
    **{f"kept_{name}": kept_answer(name) for name in KEPT},
    "stream_step_ingest": streamed_steps,
    "stream_refresh": streamed_sets,
    "stream_throughput": streamed_throughput,
    "stream_job_reports": streamed_job_reports,
    "sweep_q06": swept_q06,
    "sweep_q14": swept_q14,
    "gen_draw": draws,
    "gen_jump": jumps,
    "gen_pick": picks,
    "gen_name": names,
    "gen_text": comments,
    "gen_sparse_key": sparse_keys,
    **{f"gen_{table}": generated(table, *keys) for table, keys in GENERATED.items()},
}
