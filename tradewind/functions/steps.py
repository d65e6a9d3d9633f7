"""Step ranges: the text ``'a..b'`` and the list of steps it stands for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def expand(text: Column) -> Column:
    """``'5'`` to [5], ``'2..4'`` to [2,3,4]; malformed or falling ranges to []."""
    parts = F.split(text, r"\.\.")
    bound = lambda i: F.get(parts, i).try_cast("int")
    first = bound(0)
    last = F.when(F.size(parts) == 1, first).when(F.size(parts) == 2, bound(1))
    return F.when(first <= last, F.sequence(first, last)).otherwise(
        F.array().cast("array<int>"))


def label(steps: Column) -> Column:
    """The list of steps as ``'first..last'``; null stays null."""
    end = lambda i: F.coalesce(F.try_element_at(steps, F.lit(i)).cast("string"), F.lit(""))
    return F.when(steps.isNotNull(), F.concat(end(1), F.lit(".."), end(-1)))


def last_scale(text: Column, factor: int, children: int) -> Column:
    """Scale reached by the last step of ``'a..b'``, cut to a whole number."""
    last = F.split_part(text, F.lit(".."), F.lit(2)).try_cast("bigint")
    return F.floor(last * F.lit(factor) / F.lit(children)).cast("bigint")
