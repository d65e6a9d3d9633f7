"""Ordered prefixes and percentiles against plain Python, with one hot group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators.ordered import (
    carry_forward, exact_percentiles, id_block, prefix_sum, row_numbers)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.5 else rng.choice("abc"),
             rng.randint(-5, 20), rng.choice([None, None, rng.randint(0, 9)]))
            for i in range(0, 4000, 3)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark, data):
    made = spark.createDataFrame(data, "id bigint, g string, v bigint, maybe int")
    return made.withColumn("block", id_block("id", bits=5))


def by_group(data):
    groups = {}
    for row in sorted(data):
        groups.setdefault(row[1], []).append(row)
    return groups


def test_prefix_sum(frame, data):
    got = {r.id: (r.before, r.whole) for r in
           prefix_sum(frame, ["g"], "block", "id", F.col("v"), "before", total="whole").collect()}
    for rows in by_group(data).values():
        before, whole = 0, sum(r[2] for r in rows)
        for row in rows:
            assert got[row[0]] == (before, whole)
            before += row[2]


def test_row_numbers_with_and_without_group(frame, data):
    got = {r.id: r.n for r in row_numbers(frame, ["g"], "block", "id", "n").collect()}
    for rows in by_group(data).values():
        assert [got[r[0]] for r in rows] == list(range(1, len(rows) + 1))
    plain = {r.id: r.n for r in row_numbers(frame, [], "block", "id", "n").collect()}
    assert [plain[r[0]] for r in sorted(data)] == list(range(1, len(data) + 1))


def test_carry_forward(frame, data):
    got = {r.id: r.last for r in
           carry_forward(frame, ["g"], "block", "id", "maybe", "last").collect()}
    for rows in by_group(data).values():
        last = None
        for row in rows:
            assert got[row[0]] == last
            last = row[3] if row[3] is not None else last


def test_exact_percentiles(frame, data):
    points = {"p0": 0.0, "half": 0.5, "p98": 0.98, "top": 1.0}
    for limit in (4096, 4):  # small brackets are narrowed again and again
        got = {r.g: r for r in exact_percentiles(frame, ["g"], "v", points, limit=limit).collect()}
        for group, rows in by_group(data).items():
            values = [r[2] for r in rows]
            for name, point in points.items():
                assert got[group][name] == pytest.approx(np.percentile(values, point * 100))


def test_percentiles_narrow_a_large_group(spark):
    rows = spark.range(60000).selectExpr("'one' as g", "pow(id, 1.5) as v")
    limit = 64
    result = exact_percentiles(rows, ["g"], "v", {"half": 0.5, "p99": 0.99}, limit=limit)
    got, values = result.first(), [i ** 1.5 for i in range(60000)]
    assert got.half == pytest.approx(np.percentile(values, 50)) and got.p99 == pytest.approx(np.percentile(values, 99))
