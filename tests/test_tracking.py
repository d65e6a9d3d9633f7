"""Reports over small tracking tables with known answers."""

import pytest
from pyspark.sql import functions as F

from tradewind import registry
from tradewind.functions import steps as S
from tradewind.operators import tracking as K
from tradewind.schema import JOB, QUERY, RUN
from tradewind.sources.tracking import Tracking, read_dump, read_logs, read_packed_logs, write_dump, write_packed_logs
from datetime import datetime

DAY = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    run = spark.createDataFrame([
        (1, "alpha", "one", None, "full", DAY, None, 300),
        (2, "beta", "two", '{"a": 1}', "full", DAY, 9.5, 300)], RUN)
    job = spark.createDataFrame([
        (1, 1, "initdb", DAY, 10.0, [1, 2]), (2, 2, "initdb", DAY, 11.0, [41, 80]),
        (3, 1, "stream", DAY, 60.0, None), (4, 2, "load", DAY, 5.0, [161, 300]),
        (5, 1, "stream", DAY, 30.0, None), (6, 2, "vacuum", DAY, 1.0, None)], JOB)
    query = spark.createDataFrame(
        [(i, 3, str(i % 2), float(i)) for i in range(1, 7)] + [(7, 5, "0", 0.0)], QUERY)
    return Tracking(run, job, query)


def test_results(tables):
    got = {(r.run, r.job_number): (r.job, r.steps, r["count"]) for r in K.results(tables).collect()}
    assert got[("alpha", 1)] == ("initdb", "1..2", 1)
    assert got[("alpha", 2)] == ("stream", None, 6)
    assert got[("beta", 3)] == ("vacuum", None, 1)


def test_queries_per_minute(tables):
    got = {(r.run, r.job, r.duration): r for r in K.queries_per_minute(tables).collect()}
    assert len(got) == 5  # the vacuum job is neither load nor stream
    stream = got[("alpha", "stream", 60.0)]
    assert (stream.queries, stream.qtime, stream.qpm, stream.sf) == (6, 3.5, round(6 / 21 * 60, 4), None)
    assert got[("alpha", "stream", 30.0)].qpm is None  # no time passed
    load = got[("beta", "load", 5.0)]
    assert (load.sf, load.queries, load.qtime, load.qpm) == (300, 0, None, None)


def test_latest_load_looks_across_runs(tables):
    assert {r.id: r.sf for r in K.latest_load(tables).collect()} == {
        1: None, 2: 2, 3: 80, 4: 80, 5: 300, 6: 300}
    assert {r.id: r.sf for r in K.latest_load(tables, per_run=True).collect()} == {
        1: None, 2: None, 3: 2, 4: 80, 5: 2, 6: 300}


def test_query_timings(tables):
    rows = {(r.sf, r.query): r for r in K.query_timings(tables).collect()}
    even = rows[(80, "0")]
    assert (even["count"], even.average, even.median) == (3, 4.0, 4.0)
    assert even["90%"] == pytest.approx(5.6)


def test_summary_compares_steps_as_text(tables):
    got = {r.run: r for r in K.run_summary(tables).collect()}
    assert got["beta"].step == "41..80" and got["beta"].current_job == "vacuum"
    assert got["alpha"].queries == 6 and got["alpha"].total_duration == 100.0
    assert [r.run for r in K.run_summary(tables, "beta").collect()] == ["beta"]


def test_delete_and_unknown_run(tables):
    left = K.delete_run(tables, "alpha")
    assert [f.count() for _, f in left.items()] == [1, 3, 0]
    same = K.delete_run(tables, "nobody")
    assert [f.count() for _, f in same.items()] == [2, 6, 7]


def test_merge_renumbers(tables):
    both = K.merge(tables, tables)
    assert [f.count() for _, f in both.items()] == [4, 12, 14]
    for _, frame in both.items():
        assert frame.select("id").distinct().count() == frame.count()
    assert both.query.join(both.job, F.col("job") == both.job.id, "left_anti").count() == 0
    doubled = K.results(both).groupBy("run").count().collect()
    assert {r["count"] for r in doubled} == {6}


def test_merge_of_nothing(tables):
    empty = Tracking(*[f.filter("false") for _, f in tables.items()])
    assert [f.count() for _, f in K.merge(tables, empty).items()] == [2, 6, 7]
    assert [f.count() for _, f in K.merge(empty, tables).items()] == [2, 6, 7]


def test_set_durations(spark, tables):
    new = spark.createDataFrame([(1, 3.0)], "id bigint, duration double")
    got = {r.id: r.duration for r in K.set_durations(tables.run, new).collect()}
    assert got == {1: 3.0, 2: 9.5}


def test_dump_round_trip(spark, tables, tmp_path):
    write_dump(tables, str(tmp_path))
    back = read_dump(spark, str(tmp_path))
    for (_, a), (_, b) in zip(tables.items(), back.items()):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_logs_of_files_in_parts(spark, tmp_path):
    def put(log, part, lines):
        folder = tmp_path / f"log={log}" / f"part={part}"
        folder.mkdir(parents=True)
        (folder / "run.txt").write_text("\n".join(lines) + "\n")
    put("a", 0, ["Timing is on.", "Time: 9.0 ms", "select", " 1", "Time: 1.5 ms", "select"])
    put("a", 1, ["", "Time: 2.5 ms (00:02)", "Time: 7.0 ms", "select", "select", "Time: 3.5 ms"])
    put("b", 0, ["select", "Time: 4.0 ms"])
    names = K.planned_names(spark.createDataFrame(
        [("a", "1 4 1"), ("b", "6 12")], "log string, queries string"))
    lines = read_logs(spark, str(tmp_path))
    got = {(r.log, r.name): r.timing for r in K.extract_query_timings(lines, names).collect()}
    assert got == {("a", "1"): "3.5 ms", ("a", "4"): "2.5 ms", ("b", "6"): "4.0 ms"}


def test_step_ranges(spark):
    texts = ["5", "2..4", "x", "1..2..3", "4..2", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in frame.select(S.expand(F.col("t")).alias("s")).collect()]
    assert got == [[5], [2, 3, 4], [], [], [], []]


def test_throughput(tables):
    got = {r.job_id: (r.streams, r.queries, r.queries_per_minute)
           for r in K.throughput(tables).collect()}
    assert got == {3: (3, 6, 6.0), 5: (1, 1, 2.0)}


def test_packed_logs_keep_names_order_and_lines(spark, tmp_path):
    rows = [("007", 0, 1, "select"), ("007", 0, 2, "a\tb\nc"), ("007", 0, 3, "Time: 1.5 ms"), ("b", None, 9, ""), (None, 3, 1, "x"),
            ("007", 10, 5, "Time: 2.5 ms"), ("007", 9, 4, "select")]
    write_packed_logs(spark.createDataFrame(rows, "log string, block bigint, pos bigint, line string"), str(tmp_path / "logs"))
    back = read_packed_logs(spark, str(tmp_path / "logs")).orderBy("log", "block", "pos").collect()
    assert [(r.log, r.block.part, r.line) for r in back] == [
        (None, 3, "x"), ("007", 0, "select"), ("007", 0, "a\tb"), ("007", 0, "c"), ("007", 0, "Time: 1.5 ms"),
        ("007", 9, "select"), ("007", 10, "Time: 2.5 ms"), ("b", None, "")]


def test_registering_writes_as_many_files_as_tasks(spark, tmp_path, monkeypatch):
    """A file for each log would make the files grow with the logs."""
    spark.range(600).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id % 300 as user_id", "concat('q', id % 2) as event_type",
        "cast(id as double) as value", "'' as props").write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(registry, "scratch", lambda _, label: str(tmp_path / label))
    got = registry.all_queries()["track_register"](spark, str(tmp_path)).collect()
    assert {(r.log, r.name): r.duration for r in got} == {(str(u), f"q{u % 2}"): (u + 300) / 1000 for u in range(300) if u % 3}
    assert len(list((tmp_path / "logs").glob("**/part-*.txt"))) <= 8
