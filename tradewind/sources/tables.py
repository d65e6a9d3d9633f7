"""Typed scans of the eight tables."""

from __future__ import annotations

import os
from collections import OrderedDict
from collections.abc import Callable
from dataclasses import dataclass, field
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradewind.schema import TABLES


@dataclass
class Listing:
    """A path's direct entries as (name, size, time), and whether they are all of its files."""
    entries: tuple
    is_flat: bool


@dataclass
class Opened:
    """What is known of a path: its schema, and frames over exactly these files."""
    listing: Listing
    schema: T.StructType
    frames: dict = field(default_factory=dict)


PATHS = 256  # opened paths that a session remembers
_opened: WeakKeyDictionary[SparkSession, OrderedDict[str, Opened]] = WeakKeyDictionary()
_lock = Lock()


def listing(spark: SparkSession, path: str) -> Listing | None:
    """One call to the file system that holds the path; None if nothing is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    found = [(s.getPath().getName(), s.getLen(), s.getModificationTime(), s.isDirectory()) for s in files.listStatus(place)]
    return Listing(tuple(sorted(f[:3] for f in found)), not any(f[3] for f in found))


def open_path(spark: SparkSession, path: str) -> Opened | None:
    """The schema of a path, read from a footer only when its entries have changed; None if it has no files."""
    now = listing(spark, path)
    if now is None:
        return None
    with _lock:
        known = _opened.setdefault(spark, OrderedDict())
        opened = known.get(path)
    if opened is None or opened.listing != now:
        try:
            opened = Opened(now, spark.read.parquet(path).schema)
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
    with _lock:
        known[path] = opened
        known.move_to_end(path)
        while len(known) > PATHS:
            known.popitem(last=False)
    return opened


def stored(spark: SparkSession, folder: str, name: str, label: str = "",
           make: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
    """``name.parquet`` or the ``name`` folder as it is stored, or None if neither is there or has files.

    ``make`` turns the frame into another one, which is remembered as ``label`` as long as the files are the same.
    Frames over folders of folders are made anew each time, since a listing of the first level does not show all files.
    """
    for candidate in (f"{name}.parquet", name):
        path = os.path.join(folder, candidate)
        opened = open_path(spark, path)
        if opened is None:
            continue
        if opened.listing.is_flat and label in opened.frames:
            return opened.frames[label]
        frame = spark.read.schema(opened.schema).parquet(path)
        frame = make(frame) if make else frame
        if opened.listing.is_flat:
            opened.frames[label] = frame
        return frame
    return None


def exists(spark: SparkSession, folder: str, name: str) -> bool:
    return stored(spark, folder, name) is not None


def read_columns(spark: SparkSession, folder: str, name: str, label: str = "", make: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The stored columns of one table, or what ``make`` makes of them."""
    frame = stored(spark, folder, name, label, make)
    if frame is None:
        raise FileNotFoundError(f"no {name} below {folder}")
    return frame


def conform(frame: DataFrame, name: str, rules: dict[str, str] | None = None) -> DataFrame:
    """The declared columns in order and typed; a column that is not stored needs a rule."""
    present, columns = dict(frame.dtypes), []
    for c in TABLES[name].columns:
        wanted = c.dtype.simpleString()
        value = (rules or {}).get(c.name) if c.name not in present else c.name
        if value is None:
            raise ValueError(f"table {name} has no column {c.name}")
        columns.append(c.name if present.get(c.name) == wanted and value == c.name
                       else f"cast({value} as {wanted}) as {c.name}")
    return frame.selectExpr(*columns)


class Catalog:
    """Lazy access to one folder's tables: ``catalog.orders`` is a DataFrame.

    A catalog looks at a table's files when it is first asked for it; a new catalog sees what was added since.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def load(self, name: str) -> DataFrame:
        return read_columns(self.spark, self.folder, name, "declared", lambda frame: conform(frame, name))

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self.load(name)
        return self._frames[name]

    def most_rows(self, name: str) -> int:
        """As many rows as a table has, or more, found without deriving it."""
        return getattr(self, name).count()

    def with_tables(self, **frames: DataFrame) -> "Catalog":
        other = type(self)(self.spark, self.folder)
        other._frames = {**self._frames, **frames}
        return other
