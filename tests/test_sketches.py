"""Merged sketches keep the stated rank error against exact percentiles."""

import bisect

import pytest
from pyspark.sql import functions as F

from tradewind.operators import sketches as S
from tradewind.operators.ordered import exact_percentiles

POINTS = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


@pytest.fixture(scope="module")
def timings(spark):
    """Uneven jobs: one holds a third of all rows; durations are skewed."""
    return spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).cast("long").alias("job"), F.concat(F.lit("q"), (F.col("id") % 4).cast("string")).alias("name"),
        (F.pmod(F.xxhash64("id"), F.lit(100000)) ** 2 / 1e6).alias("duration"))


def test_rank_error_after_merging_batches(spark, timings, tmp_path):
    for batch in range(4):
        S.register(timings.filter(F.pmod(F.xxhash64("duration", F.lit(3)), F.lit(4)) == batch), str(tmp_path), batch)
    S.register(timings.filter(F.pmod(F.xxhash64("duration", F.lit(3)), F.lit(4)) == 2), str(tmp_path), 2)   # again
    got = {r.name: r for r in S.merged_percentiles(S.registered(spark, str(tmp_path)), ["name"], POINTS).collect()}
    exact = {r.name: r for r in exact_percentiles(timings, ["name"], "duration", POINTS).collect()}
    values = {}
    for r in timings.collect():
        values.setdefault(r.name, []).append(r.duration)
    assert got.keys() == exact.keys() == values.keys()
    for name, own in values.items():
        own.sort()
        assert got[name].n == len(own)
        for point, share in POINTS.items():
            low, high = bisect.bisect_left(own, got[name][point]) / len(own), bisect.bisect_right(own, got[name][point]) / len(own)
            assert low - 2 * S.rank_error() <= share <= high + 2 * S.rank_error(), (name, point)
            near = [own[max(0, min(len(own) - 1, int((share + side * 2 * S.rank_error()) * len(own))))] for side in (-1, 1)]
            assert near[0] <= exact[name][point] <= near[1]


def test_nulls_and_small_groups(spark):
    rows = spark.createDataFrame([(1, "a", 2.0), (1, "a", None), (1, "b", None), (2, "a", 4.0), (2, "a", 6.0)], "job long, name string, duration double")
    made = S.sketches(rows, ["job", "name"], "duration")
    assert {(r.job, r.name) for r in made.collect()} == {(1, "a"), (2, "a")}
    got = S.merged_percentiles(made, ["name"], {"low": 0.0, "half": 0.5, "high": 1.0}).first()
    assert (got.n, got.low, got.half, got.high) == (3, 2.0, 4.0, 6.0)
    assert S.sketches(rows.filter("false"), ["job"], "duration").count() == 0
