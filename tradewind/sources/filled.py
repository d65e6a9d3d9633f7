"""A catalog that fills what narrow test folders lack by fixed integer rules.

Only the registered queries use it.  A stored column is not recomputed, but for one-word part types, which the rules complete
where ``p_container`` is not stored either; the core catalog raises instead of filling anything in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import words as W
from tradewind.sources.tables import Catalog, conform, exists, read_columns, stored

# Fixed values of the fill-in rules for folders without these columns.
SHIP_INSTRUCTIONS = ["DELIVER IN PERSON", "COLLECT COD", "NONE", "TAKE BACK RETURN"]
ORDER_WORDS = ["special", "pending", "unusual", "express", "regular", "even"]
ORDER_NOUNS = ["packages", "requests", "accounts", "deposits"]


def choose(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"array({listed})[cast({index} as int)]"


def _phone(key: str, nation: str) -> str:
    return (f"concat_ws('-', {nation} + 10, {key} % 900 + 100, {key} * 7 % 900 + 100,"
            f" {key} * 13 % 9000 + 1000)")


def _after_shipping(days: str) -> str:
    return f"date_add(cast(l_shipdate as date), cast({days} as int))"


_LINEITEM_RULES = {
    "l_commitdate": _after_shipping("(l_orderkey*7 + l_partkey*3 + l_linenumber*13) % 61 - 30"),
    "l_receiptdate": _after_shipping("(l_orderkey*11 + l_suppkey*5 + l_linenumber) % 30 + 1"),
    "l_shipinstruct": choose(SHIP_INSTRUCTIONS, "(l_partkey + l_suppkey + l_linenumber) % 4"),
    "l_shipmode": choose(W.SHIP_MODES, "(l_orderkey + l_partkey + l_linenumber) % 7"),
    "l_comment": "''",
}
_PART_RULES = {
    "p_mfgr": "concat('Manufacturer#', p_partkey % 5 + 1)",
    "p_container": (f"concat_ws(' ', {choose(W.CONTAINER_SIZES, '(p_partkey + p_size) % 5')},"
                    f" {choose(W.CONTAINER_KINDS, '(p_partkey*3 + p_size) % 8')})"),
    "p_comment": "''",
}
# One-word types get a finish and a metal, as the questions look for those; longer ones stay.
_THREE_WORD_TYPE = (f"case when p_type like '% %' then p_type else concat_ws(' ', p_type, {choose(W.TYPE_FINISHES, 'p_partkey % 5')},"
                    f" {choose(W.TYPE_METALS, '(p_partkey*3 + p_size) % 5')}) end")
_SUPPLIER_RULES = {
    "s_address": "concat('addr ', s_suppkey * 37 % 1000)",
    "s_phone": _phone("s_suppkey", "s_nationkey"),
    "s_comment": ("case s_suppkey % 25 when 7 then 'slow Customer service Complaints'"
                  " when 8 then 'good Customer service Recommends'"
                  " else concat('quiet deposits ', s_suppkey % 11) end"),
}
_CUSTOMER_RULES = {
    "c_address": "concat('addr ', c_custkey * 41 % 1000)",
    "c_phone": _phone("c_custkey", "c_nationkey"),
    "c_comment": "concat('final accounts ', c_custkey % 13)",
}
_ORDERS_RULES = {
    "o_clerk": "concat('Clerk#', lpad(o_orderkey % 1000 + 1, 9, '0'))",
    "o_shippriority": "0",
    "o_comment": (f"concat_ws(' ', {choose(ORDER_WORDS, 'o_orderkey % 6')},"
                  f" {choose(ORDER_NOUNS, '(o_orderkey + o_custkey) % 4')}, 'sleep')"),
}
_PARTSUPP_RULES = {"ps_comment": "''"}

RULES = {
    "region": {"r_comment": "null"}, "nation": {"n_comment": "null"},
    "part": _PART_RULES, "supplier": _SUPPLIER_RULES, "partsupp": _PARTSUPP_RULES,
    "customer": _CUSTOMER_RULES, "orders": _ORDERS_RULES, "lineitem": _LINEITEM_RULES,
}


def derive_partsupp(lineitem: DataFrame) -> DataFrame:
    """The (part, supplier) pairs that lines refer to, with stock and cost."""
    pairs = lineitem.selectExpr("l_partkey as ps_partkey", "l_suppkey as ps_suppkey").distinct()
    return pairs.selectExpr(
        "ps_partkey", "ps_suppkey",
        "(ps_partkey * 31 + ps_suppkey * 17) % 9999 + 1 as ps_availqty",
        "((ps_partkey * 7919 + ps_suppkey * 104729) % 99901 + 100) / 100D as ps_supplycost")


class FilledCatalog(Catalog):
    def load(self, name: str) -> DataFrame:
        def filled(frame: DataFrame) -> DataFrame:
            if name == "part" and "p_container" not in frame.columns:
                frame = frame.withColumn("p_type", F.expr(_THREE_WORD_TYPE))
            return conform(frame, name, RULES[name])

        frame = stored(self.spark, self.folder, name, "filled", filled)
        if frame is None and name == "partsupp":
            return read_columns(self.spark, self.folder, "lineitem", "offers", lambda lines: filled(derive_partsupp(lines)))
        return frame if frame is not None else read_columns(self.spark, self.folder, name)

    def most_rows(self, name: str) -> int:
        derived = name == "partsupp" and name not in self._frames and not exists(self.spark, self.folder, name)
        return super().most_rows("lineitem" if derived else name)


def filled_catalog(spark: SparkSession, folder: str) -> FilledCatalog:
    """A fresh catalog, so that a folder that has grown is read as it is now."""
    return FilledCatalog(spark, folder)
