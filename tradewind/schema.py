"""The eight-table order/part/supplier model, declared once as data.

Every check, reader and generator is driven from these declarations.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INT, LONG, DOUBLE, DATE, STRING = (
    T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.StringType(),
)


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    max_len: int | None = None
    nullable: bool = False


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Domain:
    """Inclusive bounds; ``low``/``high`` are SQL literals for ``column``."""
    column: str
    low: str
    high: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    domains: tuple[Domain, ...] = ()
    money: tuple[str, ...] = field(default=())

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.dtype, c.nullable) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


def _text(name: str, size: int, nullable: bool = False) -> Column:
    return Column(name, STRING, size, nullable)


REGION = Table(
    "region",
    (Column("r_regionkey", INT), _text("r_name", 25), _text("r_comment", 152, True)),
    ("r_regionkey",),
    domains=(Domain("r_regionkey", "0", "4"),),
)

NATION = Table(
    "nation",
    (Column("n_nationkey", INT), _text("n_name", 25), Column("n_regionkey", INT),
     _text("n_comment", 152, True)),
    ("n_nationkey",),
    (ForeignKey("nation_region", ("n_regionkey",), "region", ("r_regionkey",)),),
    (Domain("n_nationkey", "0", "24"), Domain("n_regionkey", "0", "4")),
)

PART = Table(
    "part",
    (Column("p_partkey", LONG), _text("p_name", 55), _text("p_mfgr", 25),
     _text("p_brand", 10), _text("p_type", 25), Column("p_size", INT),
     _text("p_container", 10), Column("p_retailprice", DOUBLE), _text("p_comment", 23)),
    ("p_partkey",),
    domains=(Domain("p_size", "1", "50"), Domain("p_retailprice", "900.00", "2098.99")),
    money=("p_retailprice",),
)

SUPPLIER = Table(
    "supplier",
    (Column("s_suppkey", LONG), _text("s_name", 25), _text("s_address", 40),
     Column("s_nationkey", INT), _text("s_phone", 15), Column("s_acctbal", DOUBLE),
     _text("s_comment", 101)),
    ("s_suppkey",),
    (ForeignKey("supplier_nation", ("s_nationkey",), "nation", ("n_nationkey",)),),
    (Domain("s_acctbal", "-999.99", "9999.99"), Domain("s_nationkey", "0", "24")),
    money=("s_acctbal",),
)

PARTSUPP = Table(
    "partsupp",
    (Column("ps_partkey", LONG), Column("ps_suppkey", LONG), Column("ps_availqty", LONG),
     Column("ps_supplycost", DOUBLE), _text("ps_comment", 199)),
    ("ps_partkey", "ps_suppkey"),
    (ForeignKey("partsupp_part", ("ps_partkey",), "part", ("p_partkey",)),
     ForeignKey("partsupp_supplier", ("ps_suppkey",), "supplier", ("s_suppkey",))),
    (Domain("ps_availqty", "1", "9999"), Domain("ps_supplycost", "1.00", "1000.00")),
    money=("ps_supplycost",),
)

CUSTOMER = Table(
    "customer",
    (Column("c_custkey", LONG), _text("c_name", 25), _text("c_address", 40),
     Column("c_nationkey", INT), _text("c_phone", 15), Column("c_acctbal", DOUBLE),
     _text("c_mktsegment", 10), _text("c_comment", 117)),
    ("c_custkey",),
    (ForeignKey("customer_nation", ("c_nationkey",), "nation", ("n_nationkey",)),),
    (Domain("c_acctbal", "-999.99", "9999.99"), Domain("c_nationkey", "0", "24")),
    money=("c_acctbal",),
)

ORDERS = Table(
    "orders",
    (Column("o_orderkey", LONG), Column("o_custkey", LONG), _text("o_orderstatus", 1),
     Column("o_totalprice", DOUBLE), Column("o_orderdate", DATE),
     _text("o_orderpriority", 15), _text("o_clerk", 15), Column("o_shippriority", INT),
     _text("o_comment", 79)),
    ("o_orderkey",),
    (ForeignKey("orders_customer", ("o_custkey",), "customer", ("c_custkey",)),),
    (Domain("o_orderdate", "date '1992-01-01'", "date '1998-08-02'"),
     Domain("o_shippriority", "0", "0")),
    money=("o_totalprice",),
)

LINEITEM = Table(
    "lineitem",
    (Column("l_orderkey", LONG), Column("l_partkey", LONG), Column("l_suppkey", LONG),
     Column("l_linenumber", LONG), Column("l_quantity", DOUBLE),
     Column("l_extendedprice", DOUBLE), Column("l_discount", DOUBLE),
     Column("l_tax", DOUBLE), _text("l_returnflag", 1), _text("l_linestatus", 1),
     Column("l_shipdate", DATE), Column("l_commitdate", DATE),
     Column("l_receiptdate", DATE), _text("l_shipinstruct", 25),
     _text("l_shipmode", 10), _text("l_comment", 44)),
    ("l_orderkey", "l_linenumber"),
    (ForeignKey("lineitem_orders", ("l_orderkey",), "orders", ("o_orderkey",)),
     ForeignKey("lineitem_partsupp", ("l_partkey", "l_suppkey"), "partsupp",
                ("ps_partkey", "ps_suppkey"))),
    (Domain("l_linenumber", "1", "7"), Domain("l_quantity", "1", "50"),
     Domain("l_discount", "0.00", "0.10"), Domain("l_tax", "0.00", "0.08"),
     Domain("l_shipdate", "date '1992-01-02'", "date '1998-12-01'"),
     Domain("l_commitdate", "date '1992-01-31'", "date '1998-10-31'"),
     Domain("l_receiptdate", "date '1992-01-03'", "date '1998-12-31'")),
    money=("l_extendedprice", "l_discount", "l_tax", "l_quantity"),
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (REGION, NATION, PART, SUPPLIER, PARTSUPP, CUSTOMER, ORDERS, LINEITEM)
}

# Tracking tables: one row per benchmark run, per job of a run, per query of a job.
# Durations are seconds; ``steps`` is the list of load steps a load job covered.
RUN = T.StructType([
    T.StructField("id", LONG, False), T.StructField("name", STRING),
    T.StructField("system", STRING), T.StructField("setup", STRING),
    T.StructField("schedule", STRING), T.StructField("start", T.TimestampType()),
    T.StructField("duration", DOUBLE), T.StructField("sf", INT),
])
JOB = T.StructType([
    T.StructField("id", LONG, False), T.StructField("run", LONG, False),
    T.StructField("name", STRING, False), T.StructField("start", T.TimestampType(), False),
    T.StructField("duration", DOUBLE), T.StructField("steps", T.ArrayType(INT)),
])
QUERY = T.StructType([
    T.StructField("id", LONG, False), T.StructField("job", LONG, False),
    T.StructField("name", STRING, False), T.StructField("duration", DOUBLE),
])
TRACKING = {"run": RUN, "job": JOB, "query": QUERY}
