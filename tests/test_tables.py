"""Opening tables: footers are read once for the same files, and every change of a folder is seen."""

import os

import pytest

from tradewind.sources import tables as T
from tradewind.sources.filled import filled_catalog


@pytest.fixture
def infers(monkeypatch, spark):
    """Counts how often a schema is inferred."""
    seen = []
    whole = type(spark.read).parquet

    def parquet(reader, *paths, **options):
        frame = whole(reader, *paths, **options)
        seen.append(paths)
        return frame

    monkeypatch.setattr(type(spark.read), "parquet", parquet)
    return seen


def test_same_files_are_opened_once(spark, small, infers):
    first = filled_catalog(spark, small)
    frames = [getattr(first, n) for n in T.TABLES]
    count = len(infers)
    second = filled_catalog(spark, small)
    assert [getattr(second, n) for n in T.TABLES] == frames and len(infers) == count


def rows(spark, folder, name="t"):
    return sorted(tuple(r) for r in T.read_columns(spark, folder, name).collect())


def test_growth_overwriting_and_other_columns_are_seen(spark, tmp_path):
    folder, path = str(tmp_path), str(tmp_path / "t")
    write = lambda sql, mode: spark.sql(sql).coalesce(1).write.mode(mode).parquet(path)
    write("select 1 as a", "overwrite")
    assert rows(spark, folder) == [(1,)]
    write("select 2 as a", "append")
    assert rows(spark, folder) == [(1,), (2,)]
    write("select 'x' as b, 7L as a", "overwrite")
    assert rows(spark, folder) == [("x", 7)]


def test_partitions_are_seen(spark, tmp_path):
    folder, path = str(tmp_path), str(tmp_path / "t")
    for step in (1, 2):
        for half in (1, 2):
            spark.sql(f"select {step * half} as a").coalesce(1).write.parquet(os.path.join(path, f"step={step}/half={half}"))
            assert len(rows(spark, folder)) == 2 * (step - 1) + half


def test_missing_and_empty_folders(spark, tmp_path):
    assert not T.exists(spark, str(tmp_path), "t")
    (tmp_path / "t").mkdir()
    assert not T.exists(spark, str(tmp_path), "t")
    with pytest.raises(FileNotFoundError):
        T.read_columns(spark, str(tmp_path), "t")
    spark.sql("select 1 as a").write.parquet(str(tmp_path / "t.parquet"))
    assert rows(spark, str(tmp_path)) == [(1,)]


def test_a_session_remembers_a_bounded_number_of_paths(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "PATHS", 3)
    for at in range(5):
        spark.sql(f"select {at} as a").write.parquet(str(tmp_path / f"t{at}"))
        assert rows(spark, str(tmp_path), f"t{at}") == [(at,)]
    assert len(T._opened[spark]) == 3
