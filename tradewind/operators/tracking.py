"""Reports over runs, jobs and query timings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import steps as S
from tradewind.functions.money import exact_sum, micros, money
from tradewind.operators.ordered import (
    carry_forward, exact_percentiles, id_block, prefix_sum, row_numbers)
from tradewind.sources.tracking import Tracking

col, lit = F.col, F.lit

PERCENTILES = {"median": 0.5, "90%": 0.9, "95%": 0.95, "98%": 0.98, "99%": 0.99}


def _runs(t: Tracking) -> DataFrame:
    return t.run.select(col("id").alias("run_id"), col("name").alias("run"), "system", "schedule")


def _per_job(t: Tracking) -> DataFrame:
    """Query count and exact total duration per job: one row per job before any join."""
    return t.query.groupBy(col("job").alias("job_id")).agg(
        F.count("id").alias("queries"), F.expr(exact_sum(micros("duration"))).alias("total"))


def results(t: Tracking) -> DataFrame:
    """One row per job with its place within the run, in order of runs and starts.

    A job without queries counts one, as an outer join counted by rows does.
    """
    return _results(t).orderBy("run_id", "start", "job_id").drop("run_id", "job_id")


def _results(t: Tracking) -> DataFrame:
    numbered = row_numbers(
        t.job.withColumn("block", id_block("id")), ["run"], "block", "id", "job_number")
    jobs = numbered.select(
        col("id").alias("job_id"), col("run").alias("run_id"), col("name").alias("job"),
        "job_number", "start", "duration", S.label(col("steps")).alias("steps"))
    return (
        jobs.join(_runs(t), "run_id").join(_per_job(t), "job_id", "left")
        .select("run_id", "job_id", "run", "system", "schedule", "job", "job_number", "start", "duration", "steps",
                F.greatest(F.coalesce("queries", lit(0)), lit(1)).alias("count")))


def queries_per_minute(t: Tracking) -> DataFrame:
    """Queries per minute of summed query time, for load and stream jobs."""
    jobs = t.job.filter(col("steps").isNotNull() | col("name").rlike("stream")).select(
        col("id").alias("job_id"), col("run").alias("run_id"), col("name").alias("job"),
        "start", "duration", "steps")
    seconds = F.expr(money("total", 6))
    return (
        jobs.join(_runs(t), "run_id").join(_per_job(t), "job_id", "left")
        .orderBy("run_id", "start", "job_id")
        .select(
            "run", "system", "job", F.try_element_at("steps", lit(-1)).alias("sf"), "duration",
            F.when(col("steps").isNull(), F.try_divide(seconds, col("queries"))).alias("qtime"),
            F.coalesce("queries", lit(0)).alias("queries"),
            F.round(F.try_divide(col("queries").cast("double"), seconds) * 60, 4).alias("qpm")))


def latest_load(t: Tracking, per_run: bool = False) -> DataFrame:
    """For every job, the last step of the load job with the nearest lower id.

    All runs share one id sequence, so interleaved runs see each other's loads;
    ``per_run`` looks within the job's own run only.
    """
    jobs = t.job.select("id", "run", F.try_element_at("steps", lit(-1)).alias("reached"),
                        id_block("id").alias("block"))
    return carry_forward(
        jobs, ["run"] if per_run else [], "block", "id", "reached", "sf").select("id", "run", "sf")


def query_timings(t: Tracking, per_run: bool = False) -> DataFrame:
    """Count, average and percentiles of query durations per job and query name."""
    group = ["job", "name"]
    sums = t.query.groupBy(*group).agg(
        F.count("*").alias("count"), F.count("duration").alias("timed"),
        F.expr(exact_sum(micros("duration"))).alias("total"))
    spread = exact_percentiles(t.query, group, "duration", PERCENTILES)
    scales = latest_load(t, per_run).select(col("id").alias("job"), "sf")
    jobs = t.job.select(col("id").alias("job"), col("run").alias("run_id"),
                        col("name").alias("jobname"))
    return (
        sums.join(spread, group, "left").join(scales, "job").join(jobs, "job")
        .join(_runs(t), "run_id")
        .orderBy("run", "system", "sf", "job", "name")
        .select("run", "system", "sf", "jobname", col("name").alias("query"), "count",
                F.try_divide(F.expr(money("total", 6)), col("timed")).alias("average"),
                *[F.round(p, 6).alias(p) for p in PERCENTILES]))


def run_report(t: Tracking, run: str | None = None) -> DataFrame:
    """Results of one run, or of every run, by job number and system."""
    rows = _results(t)
    if run is not None:
        rows = rows.filter(col("run") == run)
    return rows.select("run", "system", "job", "job_number", "duration", "steps", "count").orderBy(
        "run", "job_number", "system")


def run_summary(t: Tracking, run: str | None = None) -> DataFrame:
    """Progress per run and system: last job, total time, greatest step text, queries.

    Steps are compared as text, so ``'41..80'`` ranks above ``'161..300'``.
    """
    rows = _results(t)
    if run is not None:
        rows = rows.filter(col("run") == run)
    return (
        rows.groupBy("run", "system")
        .agg(F.max("job_number").alias("current_job_number"),
             F.max_by("job", "job_number").alias("current_job"),
             F.expr(money(exact_sum(micros("duration")), 6)).alias("total_duration"),
             F.max("steps").alias("step"),
             F.sum(F.when(col("count") > 1, col("count"))).alias("queries"))
        .orderBy(col("current_job_number").desc(), "run", "system"))


def count_by_system(t: Tracking) -> DataFrame:
    """Result rows per run and system: one per job."""
    jobs = t.job.groupBy(col("run").alias("run_id")).agg(F.count("*").alias("jobs"))
    return (jobs.join(_runs(t), "run_id").groupBy("run", "system")
            .agg(F.sum("jobs").alias("count")).orderBy("run", "system"))


def delete_run(t: Tracking, run: str) -> Tracking:
    """The tables without a run of that name, its jobs and their queries."""
    runs = t.run.filter(col("name") == run).select(col("id").alias("gone_run"))
    jobs = (t.job.join(runs, col("run") == col("gone_run"), "left_semi")
            .select(col("id").alias("gone_job")))
    return Tracking(
        t.run.filter(~F.coalesce(col("name") == run, lit(False))),
        t.job.join(runs, col("run") == col("gone_run"), "left_anti"),
        t.query.join(jobs, col("job") == col("gone_job"), "left_anti"))


def merge(main: Tracking, dump: Tracking) -> Tracking:
    """Append a dump with fresh ids.

    Every id of a table moves by one constant, so references are rewritten by
    the same addition and neither a join nor a numbering pass is needed.
    """
    def shift(name: str):
        top = dict(main.items())[name].agg(F.coalesce(F.max("id"), lit(-1)).alias("v")).scalar()
        low = dict(dump.items())[name].agg(F.coalesce(F.min("id"), lit(0)).alias("v")).scalar()
        return top + 1 - low

    moved = Tracking(
        dump.run.withColumn("id", col("id") + shift("run")),
        dump.job.withColumn("id", col("id") + shift("job")).withColumn(
            "run", col("run") + shift("run")),
        dump.query.withColumn("id", col("id") + shift("query")).withColumn(
            "job", col("job") + shift("job")))
    return Tracking(*[a.unionByName(b) for (_, a), (_, b) in zip(main.items(), moved.items())])


def set_durations(rows: DataFrame, durations: DataFrame) -> DataFrame:
    """Rows with the duration given for their id, or their own."""
    new = durations.select("id", col("duration").alias("_new"))
    return (rows.join(new, "id", "left")
            .withColumn("duration", F.coalesce("_new", "duration")).select(*rows.columns))


def planned_names(streams: DataFrame) -> DataFrame:
    """(log, queries) with space-separated names to (log, ordinal, name)."""
    return streams.select("log", F.posexplode(F.split("queries", " ")).alias("ordinal", "name"))


def numbered_names(names: DataFrame, order: str) -> DataFrame:
    """(log, ``order``, name) rows to (log, ordinal, name) in that order."""
    blocked = names.withColumn("block", id_block(order))
    return row_numbers(blocked, ["log"], "block", order, "ordinal").select(
        "log", (col("ordinal") - 1).alias("ordinal"), "name")


def extract_query_timings(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Timings printed in logs, by the planned query name.

    A line starting with ``select`` arms the log; the next ``Time:`` line is the
    timing of the next planned name.  A repeated name keeps its last timing.
    """
    kind = F.when(col("line").startswith("select"), "select").when(
        col("line").startswith("Time: "), "time")
    marks = lines.withColumn("kind", kind).filter(col("kind").isNotNull())
    seen = carry_forward(marks, ["log"], "block", "pos", "kind", "previous")
    timed = seen.filter((col("kind") == "time") & (col("previous") == "select")).select(
        "log", "block", "pos", F.regexp_extract("line", "^Time: (.*?ms)", 1).alias("timing"))
    counted = prefix_sum(timed, ["log"], "block", "pos", lit(1).cast("bigint"), "ordinal")
    return (
        counted.select("log", "ordinal", "timing").join(names, ["log", "ordinal"])
        .groupBy("log", "name").agg(F.max_by("timing", "ordinal").alias("timing")))


def throughput(t: Tracking) -> DataFrame:
    """Streams and queries per minute of elapsed time, per stream job.

    A stream reports each of its names once, so the most frequent name of a
    job tells how many streams it finished.
    """
    names = t.query.groupBy("job", "name").agg(F.count("*").alias("n"))
    done = names.groupBy(col("job").alias("job_id")).agg(
        F.sum("n").alias("queries"), F.max("n").alias("streams"))
    rate = lambda n: F.round(F.try_divide(col(n).cast("double"), col("duration")) * 60, 6)
    return (
        t.job.filter(col("steps").isNull())
        .select(col("id").alias("job_id"), col("name").alias("job"), "duration")
        .join(done, "job_id")
        .select("job_id", "job", "streams", "queries", "duration",
                rate("streams").alias("streams_per_minute"),
                rate("queries").alias("queries_per_minute"))
        .orderBy("job_id"))


def timing_seconds(timing: Column) -> Column:
    """Seconds of a printed timing such as ``12.5 ms``."""
    return F.regexp_extract(timing, r"([0-9]+(?:\.[0-9]+)?)", 1).cast("double") / 1000


def register(t: Tracking, run: str, system: str, schedule: str, jobs: DataFrame, timings: DataFrame) -> Tracking:
    """Append one run with its jobs and query timings under fresh ids.

    ``jobs`` has name, start, duration and steps, ``timings`` has job (a name), name and duration in seconds.  A
    (name, system) that is registered already is refused, as are timings of an unknown job.
    """
    if not t.run.filter((col("name") == run) & (col("system") == system)).isEmpty():
        raise ValueError(f"run {run} on {system} is registered already")
    if not timings.join(jobs.select(col("name").alias("job")), "job", "left_anti").isEmpty():
        raise ValueError("a timing names an unknown job")
    after = lambda name: dict(t.items())[name].agg((F.coalesce(F.max("id"), lit(-1)) + 1).alias("v")).scalar()
    fill = lambda frame, like: frame.select(*[
        (col(f.name) if f.name in frame.columns else lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])
    own = jobs.agg(F.min("start").alias("start")).select(
        after("run").alias("id"), lit(run).alias("name"), lit(system).alias("system"), lit(schedule).alias("schedule"), "start")
    # Ids follow the order of a hash of the name, block by block.
    placed = jobs.withColumns({"hash": F.xxhash64("name"), "block": F.shiftright(F.xxhash64("name"), 48)})
    numbered = row_numbers(placed, [], "block", "hash", "place")
    new_jobs = numbered.withColumns({"id": after("job") + col("place") - 1, "run": after("run")})
    of_job = new_jobs.select(col("id").alias("job_id"), col("name").alias("job_name"), "place")
    named = timings.join(of_job, col("job") == col("job_name"))
    counted = row_numbers(named.select(col("job_id").alias("job"), "name", "duration", "place"), [], "place", "name", "nth")
    new_queries = counted.withColumn("id", after("query") + col("nth") - 1)
    return Tracking(t.run.unionByName(fill(own, t.run)), t.job.unionByName(fill(new_jobs, t.job)),
                    t.query.unionByName(fill(new_queries, t.query)))


REQUIRED = {"run": ("id", "name", "system"), "job": ("id", "run", "name"), "query": ("id", "job", "name")}


def check_tracking(t: Tracking) -> DataFrame:
    """``check_name, violations``: unique ids and run names, required values, and both references."""
    tables = dict(t.items())
    repeated = lambda frame, *keys: frame.groupBy(*keys).count().filter("count > 1")
    orphans = lambda child, key, parent: (
        child.filter(col(key).isNotNull()).groupBy(col(key).alias("k")).agg(F.count("*").alias("n"))
        .join(parent.select(col("id").alias("k")).distinct(), "k", "left_anti"))
    counts = [repeated(tables[name], "id").agg(F.count("*").alias("violations")).select(lit(f"{name}_id_unique").alias("check_name"), "violations")
              for name in tables]
    counts.append(repeated(t.run, "name", "system").agg(F.count("*").alias("violations")).select(
        lit("run_name_system_unique").alias("check_name"), "violations"))
    for name, columns in REQUIRED.items():
        missing = [F.count(F.when(col(c).isNull(), 1)) for c in columns]
        counts.append(tables[name].agg(sum(missing[1:], missing[0]).alias("violations")).select(
            lit(f"{name}_not_null").alias("check_name"), "violations"))
    for child, key, parent in (("job", "run", "run"), ("query", "job", "job")):
        counts.append(orphans(tables[child], key, tables[parent]).agg(F.coalesce(F.sum("n"), lit(0)).alias("violations")).select(
            lit(f"{child}_{key}_known").alias("check_name"), "violations"))
    return reduce(DataFrame.unionByName, counts)
