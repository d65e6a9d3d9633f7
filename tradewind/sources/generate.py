"""The eight tables as pure functions of row numbers.

A row depends on its own number only, so a table is ``spark.range`` and a
projection: no shuffle, any number of partitions, and a lost task is redone
with the same result.  A data set may be cut into ``children`` steps; step s
holds the rows n*(s-1)+1 .. n*s and the last step also the remainder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import words as W
from tradewind.functions.draws import (
    MODULUS, MULTIPLIER, STREAMS, draw, longs, pick, positioned, sparse_key, state)
from tradewind.functions.text import address, comment
from tradewind.schema import TABLES

col, lit = F.col, F.lit

# Rows at scale one.
BASE_ROWS = {"part": 200_000, "supplier": 10_000, "customer": 150_000, "orders": 1_500_000}

# First order day, days orders span, the day lines count as delivered.
FIRST_DAY = "1992-01-01"
ORDER_DAYS = 2405
CURRENT_DAY = "1995-06-17"
SUPPLIERS_PER_PART = 4
MOST_LINES = 7


@dataclass(frozen=True)
class Generator:
    spark: SparkSession
    scale: float = 1.0
    children: int = 1
    step: int = 1
    partitions: int | None = None

    # -- row ranges -------------------------------------------------------

    def total(self, table: str) -> int:
        return max(1, round(BASE_ROWS[table] * self.scale))

    def rows(self, table: str) -> tuple[int, int]:
        """First row and number of rows of this step."""
        size, extra = divmod(self.total(table), self.children)
        last = self.step == self.children
        return size * (self.step - 1) + 1, size + (extra if last else 0)

    def numbers(self, table: str) -> DataFrame:
        first, count = self.rows(table)
        return self.spark.range(first, first + count, 1, self.partitions).toDF("n")

    def _placed(self, table: str, prefix: str, numbers: DataFrame | None) -> DataFrame:
        return _place(self.numbers(table) if numbers is None else numbers, prefix)

    def reach(self, table: str) -> int:
        """Highest key up to and including this step, the remainder left out."""
        return max(1, self.total(table) // self.children * self.step)

    # -- small tables -----------------------------------------------------

    def _listed(self, rows: list[tuple], names: str) -> DataFrame:
        shown = rows if self.step == 1 else []
        return self.spark.createDataFrame(shown, names)

    def region(self) -> DataFrame:
        rows = [(key, name) for key, name in enumerate(W.REGIONS)]
        listed = self._listed(rows, "r_regionkey int, r_name string")
        listed = positioned(listed.withColumn("n", col("r_regionkey") + 1), "n", "r_comment")
        return _shaped(listed.withColumn("r_comment", comment("r_comment", 72)), "region")

    def nation(self) -> DataFrame:
        rows = [(key, name, region) for key, (name, region) in enumerate(W.NATIONS)]
        listed = self._listed(rows, "n_nationkey int, n_name string, n_regionkey int")
        listed = positioned(listed.withColumn("n", col("n_nationkey") + 1), "n", "n_comment")
        return _shaped(listed.withColumn("n_comment", comment("n_comment", 72)), "nation")

    # -- tables by row number ---------------------------------------------

    def part(self, numbers: DataFrame | None = None) -> DataFrame:
        n = col("n")
        maker = draw("p_mfgr", 1, 5)
        digit = lambda c: c.cast("string")
        return _shaped(self._placed("part", "p_", numbers).select(
            n.alias("p_partkey"), part_name().alias("p_name"),
            F.concat(lit("Manufacturer#"), digit(maker)).alias("p_mfgr"),
            F.concat(lit("Brand#"), digit(maker), digit(draw("p_brand", 1, 5)))
            .alias("p_brand"),
            pick("p_type", W.part_types()).alias("p_type"),
            draw("p_size", 1, 50).cast("int").alias("p_size"),
            pick("p_container", W.containers()).alias("p_container"),
            (retail_cents(n) / lit(100.0)).alias("p_retailprice"),
            comment("p_comment", 14).alias("p_comment")), "part")

    def partsupp(self, numbers: DataFrame | None = None) -> DataFrame:
        n, i = col("n"), col("i")
        offers = min(SUPPLIERS_PER_PART, self.reach("supplier"))
        pairs = self._placed("part", "ps_", numbers).withColumn(
            "i", F.explode(F.sequence(lit(0), lit(offers - 1))))
        return _shaped(pairs.select(
            n.alias("ps_partkey"), self.supplier_of(n, i).alias("ps_suppkey"),
            draw("ps_availqty", 1, 9999, i + 1).alias("ps_availqty"),
            (draw("ps_supplycost", 100, 100_000, i + 1) / lit(100.0)).alias("ps_supplycost"),
            comment("ps_comment", 124, i * 2 + 1).alias("ps_comment")), "partsupp")

    def supplier_of(self, part: Column, nth: Column) -> Column:
        """The nth of a part's suppliers: a walk around the suppliers in equal strides.

        The stride grows slowly with the part key.  Below a few hundred suppliers
        it is kept under a third of them, so that the four stay distinct.
        """
        suppliers = self.reach("supplier")
        quarter = max(1, suppliers // SUPPLIERS_PER_PART)
        room = max(1, (suppliers - 1) // (SUPPLIERS_PER_PART - 1) - quarter + 1)
        turn = F.call_function("div", part - 1, lit(suppliers).cast("bigint")) % room
        nth = nth % min(SUPPLIERS_PER_PART, suppliers)
        return (part + nth * (turn + quarter)) % suppliers + 1

    def supplier(self, numbers: DataFrame | None = None) -> DataFrame:
        n = col("n")
        nation = draw("s_nationkey", 0, len(W.NATIONS) - 1)
        rows = self._placed("supplier", "s_", numbers).select(
            "*", n.alias("s_suppkey"), _numbered("Supplier#", n).alias("s_name"),
            address("s_address").alias("s_address"), nation.cast("int").alias("s_nationkey"),
            phone("s_phone", nation).alias("s_phone"),
            (draw("s_acctbal", -99_999, 999_999) / lit(100.0)).alias("s_acctbal"),
            comment("s_comment", 63).alias("text"))
        return _shaped(rows.withColumn("s_comment", self._press(col("text"))), "supplier")

    @staticmethod
    def _press(text: Column) -> Column:
        """Ten of 10,000 suppliers carry a remark about customers in their comment."""
        spare = F.length(text) - 19
        gap = draw("s_press_gap", 0, spare)
        at = draw("s_press_offset", 0, spare - gap)
        verdict = F.when(draw("s_press_type", 0, 100) < 50, "Complaints").otherwise("Recommends")
        marked = F.overlay(
            F.overlay(text, lit("Customer "), (at + 1).cast("int")),
            verdict, (at + gap + 10).cast("int"))
        return F.when(draw("s_press", 1, 10_000) <= 10, marked).otherwise(text)

    def customer(self, numbers: DataFrame | None = None) -> DataFrame:
        n = col("n")
        nation = draw("c_nationkey", 0, len(W.NATIONS) - 1)
        return _shaped(self._placed("customer", "c_", numbers).select(
            n.alias("c_custkey"), _numbered("Customer#", n).alias("c_name"),
            address("c_address").alias("c_address"), nation.cast("int").alias("c_nationkey"),
            phone("c_phone", nation).alias("c_phone"),
            (draw("c_acctbal", -99_999, 999_999) / lit(100.0)).alias("c_acctbal"),
            pick("c_mktsegment", W.SEGMENTS).alias("c_mktsegment"),
            comment("c_comment", 73).alias("c_comment")), "customer")

    # -- orders and their lines -------------------------------------------

    def order_rows(self) -> DataFrame:
        """Stream position ``n`` and key of every order of this step."""
        return self.numbers("orders").withColumn("key", sparse_key(col("n")))

    def refresh_rows(self, refresh: int) -> DataFrame:
        """Positions and keys of one set of new orders, beyond the loaded ones.

        Set u takes the next 0.1 % of rows; its keys carry a sequence number in
        the bits that loaded orders leave empty.
        """
        size = self.refresh_size()
        first = (refresh - 1) * size + 1
        index = self.spark.range(first, first + size, 1, self.partitions).toDF("k")
        return index.select((col("k") + self.total("orders")).alias("n"),
                            sparse_key(col("k"), 1 + refresh // 1000).alias("key"))

    def refresh_size(self) -> int:
        return max(1, self.total("orders") // 1000)

    def deleted_keys(self, refresh: int) -> DataFrame:
        """Keys of the loaded orders that refresh set u removes."""
        size = self.refresh_size()
        first = (refresh - 1) * size + 1
        index = self.spark.range(first, first + size, 1, self.partitions).toDF("k")
        return index.select(sparse_key(col("k"), refresh // 1000).alias("o_orderkey"))

    def orders(self, rows: DataFrame | None = None) -> DataFrame:
        """Order headers, with status and total from their lines.

        ``range`` is partitioned by row number and exploding keeps that, so
        grouping the lines by row number needs no shuffle.
        """
        i = col("i")
        rows = self.order_rows() if rows is None else rows
        lines = self._lines(rows).select(
            "n", "key", self._part_of(i).alias("part"), "_at7", i,
            ship_day(col("day"), i).alias("shipped"))
        sums = lines.groupBy("n", "key").agg(
            F.count("*").alias("lines"), F.sum(_charge(col("part"), i)).alias("total"),
            F.count(F.when(_is_past(col("shipped")), lit(1))).alias("closed"))
        totals = _place(sums, "o_")
        clerks = max(1000, int(1000 * self.scale))
        return _shaped(totals.select(
            col("key").alias("o_orderkey"), self._customer_of().alias("o_custkey"),
            F.when(col("closed") == col("lines"), "F").when(col("closed") == 0, "O")
            .otherwise("P").alias("o_orderstatus"),
            (col("total") / lit(100.0)).alias("o_totalprice"),
            order_day().alias("o_orderdate"),
            pick("o_orderpriority", W.PRIORITIES).alias("o_orderpriority"),
            _numbered("Clerk#", draw("o_clerk", 1, clerks)).alias("o_clerk"),
            lit(0).alias("o_shippriority"),
            comment("o_comment", 49).alias("o_comment")), "orders")

    def _lines(self, rows: DataFrame) -> DataFrame:
        """One row per order line: its number ``i`` from zero, and the order's day."""
        return _place(rows, "o_", "l_").select(
            "n", "key", "_at7", "_at14", order_day().alias("day"),
            F.explode(F.sequence(lit(0), (line_count() - 1).cast("int"))).alias("i"))

    def lineitem(self, rows: DataFrame | None = None) -> DataFrame:
        i = col("i")
        keyed = self._lines(self.order_rows() if rows is None else rows).select(
            "*", self._part_of(i).alias("part"),
            draw("l_quantity", 1, 50, i + 1).alias("quantity"),
            ship_day(col("day"), i).alias("l_shipdate")
        ).withColumn("l_receiptdate", receipt_day(col("l_shipdate"), i))
        delivered = col("l_receiptdate") <= lit(CURRENT_DAY).cast("date")
        return _shaped(keyed.select(
            col("key").alias("l_orderkey"), col("part").alias("l_partkey"),
            self.supplier_of(col("part"), draw("l_suppkey", 0, 3, i + 1)).alias("l_suppkey"),
            (i + 1).cast("bigint").alias("l_linenumber"),
            col("quantity").cast("double").alias("l_quantity"),
            (retail_cents(col("part")) * col("quantity") / lit(100.0)).alias("l_extendedprice"),
            (_discount(i) / lit(100.0)).alias("l_discount"),
            (_tax(i) / lit(100.0)).alias("l_tax"),
            F.when(delivered, pick("l_returnflag", W.RETURN_FLAGS, i + 1)).otherwise("N")
            .alias("l_returnflag"),
            F.when(_is_past(col("l_shipdate")), "F").otherwise("O").alias("l_linestatus"),
            "l_shipdate",
            F.date_add(col("day"), draw("l_commitdate", 30, 90, i + 1).cast("int"))
            .alias("l_commitdate"),
            "l_receiptdate",
            pick("l_shipinstruct", W.SHIP_INSTRUCTIONS, i + 1).alias("l_shipinstruct"),
            pick("l_shipmode", W.SHIP_MODES, i + 1).alias("l_shipmode"),
            comment("l_comment", 27, i * 2 + 1).alias("l_comment")), "lineitem")

    def _customer_of(self) -> Column:
        """A customer up to this step whose key is not a multiple of three."""
        highest = self.reach("customer")
        drawn = draw("o_custkey", 1, highest)
        neighbour = F.when(drawn + 1 <= highest, drawn + 1).otherwise(drawn - 1)
        return F.when(drawn % 3 == 0, neighbour).otherwise(drawn)

    def _part_of(self, i: Column) -> Column:
        """A part of this step's own range."""
        size = max(1, self.total("part") // self.children)
        return draw("l_partkey", size * (self.step - 1) + 1, size * self.step, i + 1)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()


def _place(rows: DataFrame, *prefixes: str) -> DataFrame:
    """Rows with their places in all streams of the named column prefixes."""
    return positioned(rows, "n", *[s for s in STREAMS if s.startswith(prefixes)])


def _shaped(frame: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table with their declared types."""
    return frame.select(*[col(c.name).cast(c.dtype).alias(c.name) for c in TABLES[name].columns])


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(lit(prefix), F.lpad(number.cast("string"), 9, "0"))


def _is_past(day: Column) -> Column:
    return day <= lit(CURRENT_DAY).cast("date")


def _hundredth(value: Column) -> Column:
    return F.call_function("div", value, lit(100).cast("bigint"))


def retail_cents(part: Column) -> Column:
    tens = F.call_function("div", part, lit(10).cast("bigint"))
    return tens % 20001 + part % 1000 * 100 + 90_000


def phone(stream: str, nation: Column) -> Column:
    digits = [draw(stream, 100, 999, 1), draw(stream, 100, 999, 2),
              draw(stream, 1000, 9999, 3)]
    return F.concat_ws("-", *[d.cast("string") for d in (nation + 10, *digits)])


def part_name() -> Column:
    """Five distinct colour words: the first five when sorted by the row's 92 draws."""
    count = len(W.COLOURS)
    powers = longs([pow(MULTIPLIER, k, MODULUS) for k in range(count)])
    start = state("p_name")
    colours = F.array(*[lit(w) for w in W.COLOURS])
    drawn = F.transform(colours, lambda word, k: F.struct(
        (start * F.get(powers, k) % lit(MODULUS)).alias("order"), word.alias("word")))
    return F.array_join(F.slice(F.array_sort(drawn), 1, 5)["word"], " ")


def line_count() -> Column:
    return draw("o_lines", 1, MOST_LINES)


def order_day() -> Column:
    return F.date_add(lit(FIRST_DAY).cast("date"),
                      draw("o_orderdate", 0, ORDER_DAYS).cast("int"))


def ship_day(day: Column, i: Column) -> Column:
    return F.date_add(day, draw("l_shipdate", 1, 121, i + 1).cast("int"))


def receipt_day(shipped: Column, i: Column) -> Column:
    return F.date_add(shipped, draw("l_receiptdate", 1, 30, i + 1).cast("int"))


def _charge(part: Column, i: Column) -> Column:
    """A line's price after discount and tax, cut to whole cents twice."""
    price = retail_cents(part) * draw("l_quantity", 1, 50, i + 1)
    return _hundredth(_hundredth(price * (lit(100) - _discount(i))) * (lit(100) + _tax(i)))


def _discount(i: Column) -> Column:
    return draw("l_discount", 0, 10, i + 1)


def _tax(i: Column) -> Column:
    return draw("l_tax", 0, 8, i + 1)
