"""SQL for the integrity, domain and consistency checks."""

from __future__ import annotations

from oracles.views import VIEWS, with_views

VIEW_OF = {"region": "(select *, null as r_comment from region)",
           "nation": "(select *, null as n_comment from nation)"}
NAMES = ("lineitem_h", "part_h", "partsupp_h", "supplier_h", "customer_h", "orders_h")

KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "part": "p_partkey",
        "supplier": "s_suppkey", "partsupp": "ps_partkey,ps_suppkey", "customer": "c_custkey",
        "orders": "o_orderkey", "lineitem": "l_orderkey,l_linenumber"}

REFERENCES = [
    ("customer_nation", "customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("lineitem_orders", "lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("lineitem_partsupp", "lineitem", ["l_partkey", "l_suppkey"], "partsupp",
     ["ps_partkey", "ps_suppkey"]),
    ("nation_region", "nation", ["n_regionkey"], "region", ["r_regionkey"]),
    ("orders_customer", "orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("partsupp_part", "partsupp", ["ps_partkey"], "part", ["p_partkey"]),
    ("partsupp_supplier", "partsupp", ["ps_suppkey"], "supplier", ["s_suppkey"]),
    ("supplier_nation", "supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
]

TEXT = {
    "region": {"r_name": 25, "r_comment": 152},
    "nation": {"n_name": 25, "n_comment": 152},
    "part": {"p_name": 55, "p_mfgr": 25, "p_brand": 10, "p_type": 25, "p_container": 10,
             "p_comment": 23},
    "supplier": {"s_name": 25, "s_address": 40, "s_phone": 15, "s_comment": 101},
    "partsupp": {"ps_comment": 199},
    "customer": {"c_name": 25, "c_address": 40, "c_phone": 15, "c_mktsegment": 10,
                 "c_comment": 117},
    "orders": {"o_orderstatus": 1, "o_orderpriority": 15, "o_clerk": 15, "o_comment": 79},
    "lineitem": {"l_returnflag": 1, "l_linestatus": 1, "l_shipinstruct": 25, "l_shipmode": 10,
                 "l_comment": 44},
}

COLUMNS = {
    "region": "r_regionkey r_name r_comment",
    "nation": "n_nationkey n_name n_regionkey n_comment",
    "part": "p_partkey p_name p_mfgr p_brand p_type p_size p_container p_retailprice p_comment",
    "supplier": "s_suppkey s_name s_address s_nationkey s_phone s_acctbal s_comment",
    "partsupp": "ps_partkey ps_suppkey ps_availqty ps_supplycost ps_comment",
    "customer": "c_custkey c_name c_address c_nationkey c_phone c_acctbal c_mktsegment c_comment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority "
              "o_clerk o_shippriority o_comment",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
                "l_discount l_tax l_returnflag l_linestatus l_shipdate l_commitdate "
                "l_receiptdate l_shipinstruct l_shipmode l_comment",
}

MONEY = {"p_retailprice", "s_acctbal", "ps_supplycost", "c_acctbal", "o_totalprice",
         "l_quantity", "l_extendedprice", "l_discount", "l_tax"}

BOUNDS = {
    "region": {"r_regionkey": ("0", "4")},
    "nation": {"n_nationkey": ("0", "24"), "n_regionkey": ("0", "4")},
    "part": {"p_size": ("1", "50"), "p_retailprice": ("900.00", "2098.99")},
    "supplier": {"s_acctbal": ("-999.99", "9999.99"), "s_nationkey": ("0", "24")},
    "partsupp": {"ps_availqty": ("1", "9999"), "ps_supplycost": ("1.00", "1000.00")},
    "customer": {"c_acctbal": ("-999.99", "9999.99"), "c_nationkey": ("0", "24")},
    "orders": {"o_orderdate": ("date '1992-01-01'", "date '1998-08-02'"),
               "o_shippriority": ("0", "0")},
    "lineitem": {"l_linenumber": ("1", "7"), "l_quantity": ("1", "50"),
                 "l_discount": ("0", "0.10"), "l_tax": ("0", "0.08"),
                 "l_shipdate": ("date '1992-01-02'", "date '1998-12-01'"),
                 "l_commitdate": ("date '1992-01-31'", "date '1998-10-31'"),
                 "l_receiptdate": ("date '1992-01-03'", "date '1998-12-31'")},
}


def source(table: str) -> str:
    return VIEW_OF.get(table, f"{table}_h")


def _all(parts: list[str], order: str) -> str:
    return with_views(" union all ".join(parts) + f" order by {order}", *NAMES)


def primary_keys() -> str:
    return _all([f"""
        select '{t}' as table_name, '{k}' as key_columns, cast(sum(n) as bigint) as rows,
               count(*) as distinct_keys, count(*) filter (n > 1) as repeated_keys,
               cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as repeated_rows,
               cast(0 as bigint) as null_keys
        from (select {k}, count(*) as n from {source(t)} group by {k})""" for t, k in KEYS.items()],
        "table_name")


def foreign_keys() -> str:
    parts = []
    for name, child, columns, parent, parents in REFERENCES:
        match = " and ".join(f"p.{b} = c.{a}" for a, b in zip(columns, parents))
        key = columns[0] if len(columns) == 1 else f"({', '.join(columns)})"
        parts.append(f"""
          select '{name}' as constraint_name, '{child}' as table_name, '{parent}' as parent_name,
                 count(distinct {key}) as orphan_keys, count(*) as orphan_rows
          from {source(child)} c
          where not exists (select 1 from {source(parent)} p where {match})""")
    return _all(parts, "constraint_name")


def not_null() -> str:
    return _all([
        f"select '{t}' as table_name, '{c}' as column_name, count(*) - count({c}) as nulls "
        f"from {source(t)}"
        for t, cs in COLUMNS.items() for c in cs.split() if c not in ("r_comment", "n_comment")],
        "table_name, column_name")


def lengths() -> str:
    return _all([
        f"select '{t}' as table_name, '{c}' as column_name, {size} as max_length, "
        f"cast(coalesce(max(length({c})), 0) as int) as longest, "
        f"count(*) filter (length({c}) > {size}) as too_long from {source(t)}"
        for t, cs in TEXT.items() for c, size in cs.items()], "table_name, column_name")


def domains() -> str:
    return _all([
        f"select '{t}' as table_name, '{c}' as column_name, count(*) filter ({c} < {low}) as below, "
        f"count(*) filter ({c} > {high}) as above from {source(t)}"
        for t, cs in BOUNDS.items() for c, (low, high) in cs.items()], "table_name, column_name")


def consistency() -> str:
    line = """select *, (cast(l_extendedprice * 100 as bigint)
                          * (100 - cast(l_discount * 100 as bigint)) // 100)
                         * (100 + cast(l_tax * 100 as bigint)) // 100 as charge from lineitem_h"""
    rule = lambda name, good, frm: (
        f"select '{name}' as rule, count(*) as checked, "
        f"count(*) filter (not coalesce({good}, false)) as violations from {frm}")
    return with_views(" union all ".join([
        rule("returnflag_follows_receipt",
             "(l_returnflag = 'N') = (l_receiptdate > date '1995-06-17')", "line"),
        rule("linestatus_follows_shipping",
             "(l_linestatus = 'F') = (l_shipdate <= date '1995-06-17')", "line"),
        rule("orderstatus_follows_lines",
             "o_orderstatus = case when open = 0 then 'F' when open = n then 'O' else 'P' end", "o"),
        rule("totalprice_is_sum_of_lines", "cast(o_totalprice * 100 as bigint) = charge", "o"),
        rule("one_to_seven_lines", "n between 1 and 7", "o"),
    ]) + " order by rule", "lineitem_h", "orders_h", extra=f"""
        line as ({line}),
        o as (select * from orders_h left join (
                select l_orderkey, count(*) as n, count(*) filter (l_linestatus <> 'F') as open,
                       sum(charge) as charge from line group by l_orderkey)
              on o_orderkey = l_orderkey)""")


def checksums() -> str:
    def text(column: str) -> str:
        value = f"cast({column} * 100 as bigint)" if column in MONEY else column
        return f"coalesce(cast({value} as varchar), '~')"
    return _all([
        f"select '{t}' as table_name, count(*) as rows, cast(sum(cast(concat('0x', "
        f"left(md5(concat_ws('|', {', '.join(text(c) for c in cs.split())})), 8)) as bigint)) "
        f"as varchar) as checksum from {source(t)}" for t, cs in COLUMNS.items()], "table_name")


def cardinalities() -> str:
    return with_views(
        "select " + ", ".join(
            f"(select count(*) from {source(t)}) as {'lineitems' if t == 'lineitem' else t}"
            for t in COLUMNS), *NAMES)


def checks() -> dict[str, str]:
    return {
        "cardinalities": cardinalities(),
        "check_primary_keys": primary_keys(),
        "check_foreign_keys": foreign_keys(),
        "check_not_null": not_null(),
        "check_lengths": lengths(),
        "check_domains": domains(),
        "check_consistency": consistency(),
        "column_checksum": checksums(),
    }
