"""Join forms that need more than one built-in join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_aware_anti(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left_key NOT IN (select right_key from right)`` for a right side of any size.

    The SQL form always broadcasts its subquery.  Here the match is an ordinary
    anti join, and SQL's null rules become one scalar: how much a left key must
    bring to stay, 0 (right side empty: anything), 1 (a value) or 2 (a null on
    the right: nothing does).
    """
    keys = right.select(F.col(right_key).alias("_key"))
    needed = keys.agg(F.expr(
        "case when count(*) = 0 then 0 when count(*) = count(_key) then 1 else 2 end as needed"
    )).scalar()
    return (
        left.join(keys.filter("_key is not null").distinct(), F.col(left_key) == F.col("_key"),
                  "left_anti")
        .filter(F.col(left_key).isNotNull().cast("int") >= needed))
