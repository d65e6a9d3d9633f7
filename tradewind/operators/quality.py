"""Integrity, domain and consistency checks, driven by the declared model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.money import REVENUE, cents, exact_sum
from tradewind.schema import TABLES
from tradewind.sources.tables import Catalog

col, lit = F.col, F.lit


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count(condition) -> "F.Column":
    """Rows that meet a condition; zero, not null, on an empty table."""
    return F.count(F.when(condition, lit(1)))


def cardinalities(c: Catalog) -> DataFrame:
    """One row with the row counts of the eight tables."""
    labels = {"customer": "customer", "lineitem": "lineitems", "orders": "orders",
              "part": "part", "partsupp": "partsupp", "supplier": "supplier",
              "nation": "nation", "region": "region"}
    counts = _union([
        getattr(c, table).agg(F.count("*").alias("n")).select(lit(label).alias("label"), "n")
        for table, label in labels.items()])
    return counts.agg(*[F.max(F.when(col("label") == label, col("n"))).alias(label)
                        for label in labels.values()])


KEYS_PER_TASK = 1 << 19  # what one task adds up in memory, whatever the table's size


def rows_per_key(rows: DataFrame, keys: tuple[str, ...], most: int) -> DataFrame:
    """The keys with their rows as ``n``, in as many tasks as ``most`` rows need.

    Nearly all keys differ, so adding up before the shuffle would only hold them all in memory.  Rows of one key are dealt
    over all tasks first, so a hot key reaches the second shuffle as one row a task.
    """
    tasks = -(-most // KEYS_PER_TASK)
    if tasks <= 1:
        return rows.groupBy(*keys).agg(F.count("*").alias("n"))
    dealt = rows.select(*keys, (F.monotonically_increasing_id() % tasks).alias("_deal"))
    parts = dealt.repartition(tasks, *keys, "_deal").groupBy(*keys, "_deal").agg(F.count("*").alias("_n"))
    return parts.repartition(tasks, *keys).groupBy(*keys).agg(F.sum("_n").alias("n"))


def primary_keys(c: Catalog) -> DataFrame:
    """Rows, distinct keys, repeated keys and null keys per table."""
    checks = []
    for table in TABLES.values():
        filled = reduce(lambda a, b: a & b, [col(k).isNotNull() for k in table.primary_key])
        most = c.most_rows(table.name)
        keys = rows_per_key(getattr(c, table.name), table.primary_key, most)
        checks.append(keys.agg(
            F.coalesce(F.sum("n"), lit(0)).alias("rows"), F.count("*").alias("distinct_keys"),
            _count(col("n") > 1).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(col("n") > 1, col("n"))), lit(0)).alias("repeated_rows"),
            F.coalesce(F.sum(F.when(~filled, col("n"))), lit(0)).alias("null_keys"),
        ).select(lit(table.name).alias("table_name"),
                 lit(",".join(table.primary_key)).alias("key_columns"), "*"))
    return _union(checks).orderBy("table_name")


def foreign_keys(c: Catalog) -> DataFrame:
    """Child keys without a parent, and how many rows carry them.

    Child keys are counted first, so a hot key reaches the join as one row.
    """
    checks = []
    for table in TABLES.values():
        for fk in table.foreign_keys:
            filled = reduce(lambda a, b: a & b, [col(k).isNotNull() for k in fk.columns])
            children = (getattr(c, table.name).filter(filled)
                        .groupBy(*fk.columns).agg(F.count("*").alias("n")))
            parents = getattr(c, fk.parent).select(*fk.parent_columns)
            matches = [col(a) == col(b) for a, b in zip(fk.columns, fk.parent_columns)]
            orphans = children.join(parents, reduce(lambda a, b: a & b, matches), "left_anti")
            checks.append(orphans.agg(
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("n"), lit(0)).alias("orphan_rows"),
            ).select(lit(fk.name).alias("constraint_name"), lit(table.name).alias("table_name"),
                     lit(fk.parent).alias("parent_name"), "orphan_keys", "orphan_rows"))
    return _union(checks).orderBy("constraint_name")


def _one_pass(frame: DataFrame, measures: dict[tuple, "F.Column"], labels: list[str],
              outputs: list[str]) -> DataFrame:
    """Aggregate all measures of a table in one scan, then one row per label tuple."""
    names = {key: f"m{i}" for i, key in enumerate(measures)}
    wide = frame.agg(*[F.struct(*m).alias(names[k]) for k, m in measures.items()])
    entries = F.array(*[
        F.struct(*[lit(v).alias(n) for n, v in zip(labels, key)],
                 *[col(names[key])[o].alias(o) for o in outputs]) for key in measures])
    return wide.select(F.inline(entries))


def not_null(c: Catalog) -> DataFrame:
    """Nulls per mandatory column."""
    return _union([
        _one_pass(getattr(c, t.name),
                  {(t.name, k.name): [_count(col(k.name).isNull()).alias("nulls")]
                   for k in t.columns if not k.nullable},
                  ["table_name", "column_name"], ["nulls"])
        for t in TABLES.values()]).orderBy("table_name", "column_name")


def lengths(c: Catalog) -> DataFrame:
    """Longest value and number of over-long values per text column."""
    return _union([
        _one_pass(getattr(c, t.name),
                  {(t.name, k.name, k.max_len): [
                      F.coalesce(F.max(F.length(k.name)), lit(0)).alias("longest"),
                      _count(F.length(k.name) > k.max_len).alias("too_long")]
                   for k in t.columns if k.max_len},
                  ["table_name", "column_name", "max_length"], ["longest", "too_long"])
        for t in TABLES.values() if any(k.max_len for k in t.columns)
    ]).orderBy("table_name", "column_name")


def domains(c: Catalog) -> DataFrame:
    """Values below and above the declared range per column."""
    return _union([
        _one_pass(getattr(c, t.name),
                  {(t.name, d.column): [
                      _count(F.expr(f"{d.column} < {d.low}")).alias("below"),
                      _count(F.expr(f"{d.column} > {d.high}")).alias("above")]
                   for d in t.domains},
                  ["table_name", "column_name"], ["below", "above"])
        for t in TABLES.values() if t.domains]).orderBy("table_name", "column_name")


# Fixed value: the day that separates delivered from open lines.
CURRENT_DATE = "date '1995-06-17'"


def consistency(c: Catalog) -> DataFrame:
    """Rules that tie columns together; they hold for generated data."""
    line = c.lineitem.select(
        "l_orderkey", "l_linestatus", "l_returnflag", "l_shipdate", "l_receiptdate",
        F.expr(REVENUE).alias("gross"), F.expr(f"100 + {cents('l_tax')}").alias("tax"))
    # Whole cents: both divisions cut the fraction off.
    line = line.withColumn("charge", F.expr("(gross div 100) * tax div 100"))
    lines = _one_pass(
        line,
        {("returnflag_follows_receipt",): [
            F.count("*").alias("checked"),
            _count((col("l_returnflag") == "N") != F.expr(f"l_receiptdate > {CURRENT_DATE}"))
            .alias("violations")],
         ("linestatus_follows_shipping",): [
            F.count("*").alias("checked"),
            _count((col("l_linestatus") == "F") != F.expr(f"l_shipdate <= {CURRENT_DATE}"))
            .alias("violations")]},
        ["rule"], ["checked", "violations"])
    per_order = line.groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), _count(col("l_linestatus") == "F").alias("closed"),
        F.sum("charge").alias("charge"))
    expected = (F.when(col("closed") == col("lines"), "F").when(col("closed") == 0, "O")
                .otherwise("P"))
    joined = (
        c.orders.select("o_orderkey", "o_orderstatus", F.expr(cents("o_totalprice")).alias("price"))
        .join(per_order, col("o_orderkey") == col("l_orderkey"), "left"))
    broken = lambda good: [F.count("*").alias("checked"),
                           _count(~F.coalesce(good, lit(False))).alias("violations")]
    orders = _one_pass(
        joined,
        {("orderstatus_follows_lines",): broken(col("o_orderstatus") == expected),
         ("totalprice_is_sum_of_lines",): broken(col("price") == col("charge")),
         ("one_to_seven_lines",): broken(col("lines").between(1, 7))},
        ["rule"], ["checked", "violations"])
    return lines.unionByName(orders).orderBy("rule")


def column_checksum(c: Catalog) -> DataFrame:
    """Rows and an order-independent checksum per table, over all column values.

    Each row's values are joined as text (money as cents, dates as ISO text)
    and hashed; the first 32 bits of the hashes are added up.
    """
    sums = []
    for t in TABLES.values():
        values = [
            F.expr(cents(k.name)).cast("string") if k.name in t.money else col(k.name).cast("string")
            for k in t.columns]
        text = F.concat_ws("|", *[F.coalesce(v, lit("~")) for v in values])
        code = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        sums.append(getattr(c, t.name).select(code.alias("code")).agg(
            F.count("*").alias("rows"), F.expr(exact_sum("code")).cast("string").alias("checksum")
        ).select(lit(t.name).alias("table_name"), "*"))
    return _union(sums).orderBy("table_name")
