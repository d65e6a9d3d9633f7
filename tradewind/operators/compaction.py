"""Refresh sets folded into the stored tables, file by file.

``refreshed`` merges every stored set at every read, so reads grow with the history.  Here ``orders`` and
``lineitem`` are sets of files named by a version, and ``compact`` makes the next one: a join of the tables' keys with the deleted
ones names the files that hold an affected row, only these are written again, files of new orders are added, and all others are taken
over as they are.  A version is a small Parquet table of file names and the number of the last set it contains; it counts once its
``_SUCCESS`` file is there, so a compaction that dies leaves the version before.  A reader of a version is not disturbed:
old files go only with ``vacuum``.

A set counts by number: after set 7 is folded in, a set with a smaller number that comes late is left out, and rows of
the version are older than any later set, as base rows are.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.refresh import KEYS, counting, latest_deletes, merged
from tradewind.schema import TABLES
from tradewind.session import stored
from tradewind.sources.tables import Catalog, listing

col, lit = F.col, F.lit
MANIFEST = "table_name string, path string, applied int"


@dataclass(frozen=True)
class Version:
    number: int
    applied: int
    files: dict[str, list[str]]


def _versions(folder: str) -> str:
    return os.path.join(folder, "versions")


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    found = listing(spark, _versions(folder))
    return sorted(int(name) for name, *_ in found.entries if name.isdigit()) if found else []


def _is_whole(spark: SparkSession, folder: str, number: int) -> bool:
    found = listing(spark, os.path.join(_versions(folder), str(number)))
    return found is not None and any(name == "_SUCCESS" for name, *_ in found.entries)


def read_version(spark: SparkSession, folder: str, number: int) -> Version:
    rows = spark.read.schema(MANIFEST).parquet(os.path.join(_versions(folder), str(number))).collect()
    files = {name: sorted(r.path for r in rows if r.table_name == name and r.path) for name in KEYS}
    return Version(number, max(r.applied for r in rows), files)


def latest(spark: SparkSession, folder: str) -> Version:
    for number in reversed(_numbers(spark, folder)):
        if _is_whole(spark, folder, number):
            return read_version(spark, folder, number)
    raise FileNotFoundError(f"no version below {folder}")


def _publish(spark: SparkSession, folder: str, applied: int, files: dict[str, list[str]]) -> Version:
    """Write the next version; two writers of one number do not both succeed."""
    number = max(_numbers(spark, folder), default=0) + 1
    rows = [(name, path, applied) for name in KEYS for path in files[name] or [None]]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(os.path.join(_versions(folder), str(number)))
    return Version(number, applied, {name: sorted(files[name]) for name in KEYS})


def _write(frame: DataFrame, folder: str, name: str) -> list[str]:
    path = os.path.join(folder, "data", name, uuid.uuid4().hex)
    frame.write.parquet(path)
    return list(frame.sparkSession.read.schema(frame.schema).parquet(path).inputFiles())


def begin(base: Catalog, folder: str, files: int | None = None) -> Version:
    """The first version: both tables in ranges of their order key, so that a set meets few files."""
    written = {}
    for name, key in KEYS.items():
        rows = getattr(base, name)
        ranged = rows.repartitionByRange(files, key) if files else rows.repartitionByRange(key)
        written[name] = _write(ranged.sortWithinPartitions(key), folder, name)
    return _publish(base.spark, folder, 0, written)


def rows_of(spark: SparkSession, files: list[str], name: str) -> DataFrame:
    schema = TABLES[name].struct
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def current(base: Catalog, folder: str, store: str | None = None) -> Catalog:
    """The catalog with both tables as the last version has them, and with the sets that came since."""
    version = latest(base.spark, folder)
    at = base.with_tables(**{name: rows_of(base.spark, version.files[name], name) for name in KEYS})
    if store is None:
        return at
    return at.with_tables(**{name: merged(getattr(at, name), store, name, version.applied) for name in KEYS})


def touched_files(spark: SparkSession, files: list[str], name: str, gone: DataFrame) -> list[str]:
    """Files with a row of a deleted order.

    Only the key column is read, and only of row groups within the range of the deleted keys.
    """
    key = KEYS[name]
    low, high = gone.agg(F.min("_gone"), F.max("_gone")).first()
    if low is None or not files:
        return []
    keys = rows_of(spark, files, name).filter(col(key).between(low, high)).select(key, col("_metadata.file_path").alias("_file"))
    hit = {_own_name(r[0]) for r in keys.join(gone, col(key) == col("_gone"), "left_semi").select("_file").distinct().collect()}
    return [path for path in files if _own_name(path) in hit]


def _own_name(path: str) -> str:
    """Folder and name of a file; two spellings of one address agree in them."""
    return "/".join(path.split("/")[-2:])


def compact(spark: SparkSession, folder: str, store: str, upto: int) -> DataFrame:
    """Fold the sets up to ``upto`` in; per table the files before, rewritten, added and after, and the rows of both."""
    before = latest(spark, folder)
    if upto <= before.applied:
        return _report(spark, {name: (len(before.files[name]), 0, 0, len(before.files[name])) for name in KEYS})
    deletes = counting(spark, store, "deletes", before.applied, upto)
    gone = None if deletes is None else stored(latest_deletes(deletes), "compact-deletes")
    files, report = {}, {}
    for name in KEYS:
        key, own = KEYS[name], before.files[name]
        touched = touched_files(spark, own, name, gone) if gone is not None else []
        parts = []
        if touched:
            parts.append(rows_of(spark, touched, name).join(gone, col(key) == col("_gone"), "left_anti"))
        fresh = counting(spark, store, f"{name}_inserts", before.applied, upto)
        if fresh is not None:
            if gone is not None:
                fresh = fresh.join(gone, (col(key) == col("_gone")) & (col("refresh") <= col("_last")), "left_anti")
            parts.append(fresh.select(*TABLES[name].column_names))
        added = _write(reduce(DataFrame.unionByName, parts), folder, name) if parts else []
        files[name] = sorted(set(own) - set(touched)) + added
        report[name] = (len(own), len(touched), len(added), len(files[name]))
    _publish(spark, folder, upto, files)
    return _report(spark, report)


def _report(spark: SparkSession, counts: dict[str, tuple[int, ...]]) -> DataFrame:
    return spark.createDataFrame([(name, *n) for name, n in counts.items()],
                                 "table_name string, files_before int, rewritten int, added int, files_after int")


def retire(spark: SparkSession, folder: str, store: str) -> list[str]:
    """Delete the stored sets that the last version contains; the paths."""
    applied, gone = latest(spark, folder).applied, []
    for name in ("deletes", *(f"{n}_inserts" for n in KEYS)):
        found = listing(spark, os.path.join(store, name))
        for entry, *_ in found.entries if found else ():
            if entry.startswith("refresh=") and int(entry.removeprefix("refresh=")) <= applied:
                gone.append(os.path.join(store, name, entry))
    _delete(spark, gone)
    return gone


def vacuum(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Delete the files and versions that none of the last ``keep`` whole versions names; no job may be reading them."""
    whole = [n for n in _numbers(spark, folder) if _is_whole(spark, folder, n)]
    live = {os.path.basename(p) for n in whole[-keep:] for paths in read_version(spark, folder, n).files.values() for p in paths}
    gone = [os.path.join(_versions(folder), str(n)) for n in whole[:-keep]]
    for name in KEYS:
        place = os.path.join(folder, "data", name)
        for write, *_ in listing(spark, place).entries:
            files = [f for f, *_ in listing(spark, os.path.join(place, write)).entries if f.endswith(".parquet")]
            dead = [os.path.join(place, write, f) for f in files if f not in live]
            gone += [os.path.join(place, write)] if len(dead) == len(files) else dead
    _delete(spark, gone)
    return gone


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
