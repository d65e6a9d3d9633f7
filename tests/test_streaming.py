"""Streaming jobs: restart, redelivery, late events."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind.operators import refresh, warehouse
from tradewind.sources.generate import Generator
from tradewind.sources.tables import Catalog
from tradewind.streaming import jobs


def test_steps_arrive_one_after_another(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    schema = Generator(spark, 0.001).customer().schema
    total = 0
    for step in (1, 2, 3):
        rows = Generator(spark, 0.001, children=3, step=step).customer()
        total += rows.count()
        rows.withColumn("step", F.lit(step)).write.mode("append").partitionBy("step").parquet(landing)
        for _ in range(2):  # the second start finds nothing new
            jobs.ingest_steps(spark, schema, landing, target, state).awaitTermination()
        stored = spark.read.parquet(target)
        assert stored.count() == total and stored.agg(F.max("step")).first()[0] == step


# (set, delivery, part or None for the whole) as they land before each trigger; an empty trigger is a restart.
DELIVERIES = {
    "again later": [[(1, 1, None)], [(2, 1, None)], [(1, 2, None)]],
    "twice before one trigger": [[(1, 1, None), (1, 2, None), (2, 1, None)]],
    "in two parts": [[(1, 1, 0), (2, 1, None)], [(1, 1, 1)]],
    "parts and copies with restarts": [[(1, 1, 0), (1, 2, 0)], [], [(1, 2, 1), (2, 1, None)], [(1, 1, 1)], []],
}


@pytest.mark.parametrize("landed", list(DELIVERIES))
def test_a_set_counts_once_and_whole(spark, tmp_path, landed):
    generator = Generator(spark, 0.01)
    base = Catalog(spark, "").with_tables(orders=generator.orders(), lineitem=generator.lineitem())
    landing, store, state = (str(tmp_path / n) for n in ("landing", "store", "state"))
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "deletes": "key"}
    for trigger in DELIVERIES[landed]:
        for number, delivery, half in trigger:
            rows = generator.refresh_rows(number)
            for name, made in (("orders", generator.orders(rows)), ("lineitem", generator.lineitem(rows)),
                               ("deletes", generator.deleted_keys(number).toDF("key"))):
                own = F.lit(True) if half is None else F.hash(keys[name]) % 2 == F.lit(half) * F.sign(F.hash(keys[name]))
                (made.filter(own).withColumns({"refresh": F.lit(number), "delivery": F.lit(delivery)})
                 .write.mode("append").partitionBy("refresh", "delivery").parquet(f"{landing}/{name}"))
        for query in jobs.apply_refresh_sets(
                spark, base.orders.schema, base.lineitem.schema, landing, store, state):
            query.awaitTermination()
    result = refresh.refreshed(base, store, "orders")
    assert result.count() == 15000
    assert result.select("o_orderkey").distinct().count() == 15000
    gone = generator.deleted_keys(1).unionByName(generator.deleted_keys(2))
    assert result.join(gone, "o_orderkey").count() == 0


def test_later_delete_removes_earlier_insert(spark, tmp_path):
    generator = Generator(spark, 0.001)
    base = Catalog(spark, "").with_tables(orders=generator.orders(), lineitem=generator.lineitem())
    rows = generator.refresh_rows(1)
    refresh.write_insert_set(spark, str(tmp_path), 1, generator.orders(rows), generator.lineitem(rows))
    assert refresh.refreshed(base, str(tmp_path), "orders").count() == 1501
    refresh.write_delete_set(spark, str(tmp_path), 2, rows.select("key"))
    assert refresh.refreshed(base, str(tmp_path), "orders").count() == 1500


def test_late_events_are_dropped(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("source", "target", "state"))
    start = datetime(2024, 1, 1)

    def deliver(minutes):
        rows = [(i, start + timedelta(minutes=m), 1) for i, m in enumerate(minutes)]
        frame = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint")
        frame.coalesce(1).write.mode("append").parquet(source)
        jobs.stream_throughput(spark, frame.schema, source, target, state,
                               delay="10 minutes").awaitTermination()

    deliver([0, 0, 1, 30])
    deliver([1, 2, 31, 60])  # minutes 1 and 2 are behind the watermark at 20
    got = {r.window_start: r.queries for r in spark.read.parquet(target).collect()}
    assert got == {start: 2, start + timedelta(minutes=1): 1, start + timedelta(minutes=30): 1,
                   start + timedelta(minutes=31): 1}


def test_open_windows_are_added_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("source", "target", "state"))
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=m), i) for i, m in enumerate([0, 0, 1, 30, 55, 60, 60])]
    frame = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint")
    frame.coalesce(1).write.parquet(source)
    jobs.stream_throughput(spark, frame.schema, source, target, state, delay="10 minutes").awaitTermination()
    got = jobs.all_windows(spark, frame.schema, source, target, delay="10 minutes").collect()
    assert {r.window_start: r.queries for r in got} == {
        start + timedelta(minutes=m): n for m, n in ((0, 2), (1, 1), (30, 1), (55, 1), (60, 2))} and len(got) == 5


def test_report_interval():
    assert (jobs.report_seconds(5), jobs.report_seconds(90)) == (5, 60)


def test_segments_keep_orders_whole(spark):
    generator = Generator(spark, 0.001)
    cut = refresh.segments(generator.lineitem(), "l_orderkey", 4)
    assert cut.groupBy("l_orderkey").agg(F.count_distinct("segment").alias("n")).filter("n > 1").count() == 0
    sizes = [r["n"] for r in cut.groupBy("segment").agg(F.count_distinct("l_orderkey").alias("n")).collect()]
    assert sorted(sizes) == [375, 375, 375, 375]


def test_numbered_steps_give_the_rest_to_the_last(spark):
    frame = spark.range(5, 28).toDF("k")
    got = warehouse.numbered_steps(frame, "k", 4).groupBy("step").count().orderBy("step").collect()
    assert [(r.step, r["count"]) for r in got] == [(1, 5), (2, 5), (3, 5), (4, 8)]


def test_short_jobs_report_often(spark, tmp_path):
    """Two jobs in one stream over two triggers: intervals of five and of sixty seconds, open ones included."""
    source, target, state = (str(tmp_path / n) for n in ("events", "windows", "state"))
    begin = datetime(2024, 5, 1, 12, 0, 0)
    planned = spark.createDataFrame([(1, 60), (2, 600), (3, 600)], "job long, planned int")
    schema = spark.createDataFrame([], "job long, name string, ts timestamp").schema
    made = [(job, "last" if n % 4 == 3 else "other", begin + timedelta(seconds=7 * n)) for job in (1, 2) for n in range(24)]
    given = (spark, schema, source, planned, lambda rows: rows, "last", target, "30 seconds")
    for part in (made[:12] + made[24:36], made[12:24] + made[36:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        jobs.stream_job_windows(*given[:7], state, given[7]).awaitTermination()
    want = {}
    for job, name, ts in made:
        width = 5 if job == 1 else 60
        at = begin + timedelta(seconds=(ts - begin).total_seconds() // width * width)
        streams, queries = want.get((job, at), (0, 0))
        want[job, at] = (streams + (name == "last"), queries + 1)
    got = jobs.job_reports(*given).collect()
    assert {(r.job, r.window_start): (r.streams, r.queries) for r in got} == want and len(got) == len(want)
    last = {job: max((r for r in got if r.job == job), key=lambda r: r.window_start) for job in (1, 2)}
    assert all((r.all_streams, r.all_queries) == (6, 24) for r in last.values())
    assert last[2].elapsed == 180 and last[2].qpm == 8.0 and last[1].elapsed == 165
    written = spark.read.parquet(target).count()
    assert 0 < written < len(want)


def test_a_closed_source_without_events_has_no_reports(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("events", "windows", "state"))
    schema = spark.createDataFrame([], "job long, name string, ts timestamp").schema
    spark.createDataFrame([], schema).coalesce(1).write.parquet(source)
    planned = spark.createDataFrame([(1, 60)], "job long, planned int")
    given = (spark, schema, source, planned, lambda rows: rows, "last", target)
    jobs.stream_job_windows(*given, state).awaitTermination()
    assert jobs.job_reports(*given).count() == 0


def test_open_windows_read_late_events_only(spark, tmp_path):
    source = str(tmp_path / "events")
    rows = [(datetime(2024, 5, 1) + timedelta(minutes=n),) for n in range(600)]
    frame = spark.createDataFrame(rows, "ts timestamp")
    frame.coalesce(1).write.parquet(source)
    left, _ = jobs._still_open(spark, frame.schema, source, 60, "1 hour", "*.parquet")
    assert 55 <= left.count() <= 65 and "GreaterThan(ts" in left._jdf.queryExecution().toString()
