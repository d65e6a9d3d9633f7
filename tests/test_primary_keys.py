"""Rows per key over many tasks."""

from collections import Counter

from tradewind.operators import quality


def test_tasks_grow_with_the_rows_and_counts_are_whole(spark, monkeypatch):
    monkeypatch.setattr(quality, "KEYS_PER_TASK", 100)
    rows = [(7, 1)] * 400 + [(None, 1)] * 30 + [(k, k % 3) for k in range(500)] + [(5, None)] * 3
    frame = spark.createDataFrame(rows, "a bigint, b int")
    counted = quality.rows_per_key(frame, ("a", "b"), len(rows))
    assert counted.rdd.getNumPartitions() == 10
    assert {(r.a, r.b): r.n for r in counted.collect()} == Counter(rows)
    assert {(r.a, r.b): r.n for r in quality.rows_per_key(frame.limit(0), ("a", "b"), len(rows)).collect()} == {}
