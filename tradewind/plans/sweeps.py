"""Many parameter sets in one job: a small parameter table joined to the facts.

Facts are first summed by the columns the parameters look at, which leaves a
few thousand rows at any table size; only those meet the parameter table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.money import REVENUE, cents, exact_sum, money, ratio
from tradewind.plans.queries import months_after
from tradewind.sources.tables import Catalog

col = F.col


def q06_parameters(spark: SparkSession, years=range(1993, 1998), discounts=range(2, 10),
                   quantities=(24, 25)) -> DataFrame:
    """Every combination of year, discount (in cents) and quantity."""
    rows = [(i, *values) for i, values in enumerate(
        ((y, d, q) for y in years for d in discounts for q in quantities), start=1)]
    return spark.createDataFrame(rows, "set_id int, year int, discount int, quantity int")


def sweep_q06(c: Catalog, parameters: DataFrame) -> DataFrame:
    """Forecast revenue per parameter set."""
    first = parameters.agg(F.make_date(F.min("year"), F.lit(1), F.lit(1)).alias("day")).scalar()
    after = parameters.agg(F.make_date(F.max("year") + 1, F.lit(1), F.lit(1)).alias("day")).scalar()
    cube = (
        c.lineitem.filter((col("l_shipdate") >= first) & (col("l_shipdate") < after)).groupBy(
            F.year("l_shipdate").alias("ship_year"), F.expr(cents("l_discount")).alias("off"),
            F.expr(cents("l_quantity")).alias("amount"))
        .agg(F.expr(exact_sum(f"{cents('l_extendedprice')} * {cents('l_discount')}"))
             .alias("units")))
    # The discount band spans three cents: an equality join on each of them.
    wanted = parameters.withColumn(
        "off", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)),
                                     lambda d: (col("discount") + d).cast("bigint"))))
    matched = wanted.join(
        cube, (col("year") == col("ship_year")) & (wanted["off"] == cube["off"])
        & (col("amount") < col("quantity") * 100), "left")
    return (
        matched.groupBy("set_id", "year", "discount", "quantity")
        .agg(F.expr(money("sum(units)", 4)).alias("revenue")).orderBy("set_id"))


def q14_parameters(spark: SparkSession, first: date = date(1993, 1, 1), months: int = 60) -> DataFrame:
    rows = [(i + 1, months_after(first, i)) for i in range(months)]
    return spark.createDataFrame(rows, "set_id int, month date")


def sweep_q14(c: Catalog, parameters: DataFrame) -> DataFrame:
    """Promotion share per month."""
    first = parameters.agg(F.min("month").alias("day")).scalar()
    after = parameters.agg(F.add_months(F.max("month"), 1).alias("day")).scalar()
    sold = (
        c.lineitem.filter((col("l_shipdate") >= first) & (col("l_shipdate") < after)).groupBy("l_partkey", F.trunc("l_shipdate", "month").alias("ship_month"))
        .agg(F.expr(exact_sum(REVENUE)).alias("units")))
    promo = F.when(col("p_type").startswith("PROMO"), col("units")).otherwise(0)
    monthly = (
        sold.join(c.part.select("p_partkey", "p_type"), col("l_partkey") == col("p_partkey"))
        .groupBy("ship_month").agg(F.sum(promo).alias("promo"), F.sum("units").alias("units")))
    return (
        parameters.join(monthly, col("month") == col("ship_month"), "left")
        .select("set_id", "month",
                F.expr(ratio("promo", "units", 100)).alias("promo_revenue"))
        .orderBy("set_id"))
