"""The typed, filled-in tables as common table expressions over the raw ones.

The rules are the same integer arithmetic as in ``tradewind.sources.filled``,
written a second time for the other engine; money becomes DECIMAL(12,2) here.
"""

from __future__ import annotations


def pick(words: str, index: str) -> str:
    return f"split_part('{words}', '|', cast(1 + ({index}) as int))"


def _phone(key: str, nation: str) -> str:
    return (f"concat(cast(10 + {nation} as varchar), '-', cast(100 + {key} % 900 as varchar), "
            f"'-', cast(100 + ({key} * 7) % 900 as varchar), "
            f"'-', cast(1000 + ({key} * 13) % 9000 as varchar))")


VIEWS = {
    "lineitem_h": f"""
      select l_orderkey, l_partkey, l_suppkey, l_linenumber,
             cast(l_quantity as decimal(12,2)) as l_quantity,
             cast(l_extendedprice as decimal(12,2)) as l_extendedprice,
             cast(l_discount as decimal(12,2)) as l_discount,
             cast(l_tax as decimal(12,2)) as l_tax,
             l_returnflag, l_linestatus,
             cast(l_shipdate as date) as l_shipdate,
             cast(l_shipdate as date)
               + cast((l_orderkey*7 + l_partkey*3 + l_linenumber*13) % 61 - 30 as int) as l_commitdate,
             cast(l_shipdate as date)
               + cast(1 + (l_orderkey*11 + l_suppkey*5 + l_linenumber) % 30 as int) as l_receiptdate,
             {pick('DELIVER IN PERSON|COLLECT COD|NONE|TAKE BACK RETURN',
                   '(l_partkey + l_suppkey + l_linenumber) % 4')} as l_shipinstruct,
             {pick('REG AIR|AIR|RAIL|TRUCK|MAIL|FOB|SHIP',
                   '(l_orderkey + l_partkey + l_linenumber) % 7')} as l_shipmode,
             '' as l_comment
      from lineitem""",
    "part_h": f"""
      select p_partkey, p_name,
             concat('Manufacturer#', cast(1 + p_partkey % 5 as varchar)) as p_mfgr, p_brand,
             concat(p_type, ' ', {pick('ANODIZED|BURNISHED|PLATED|POLISHED|BRUSHED', 'p_partkey % 5')},
                    ' ', {pick('TIN|NICKEL|BRASS|STEEL|COPPER', '(p_partkey*3 + p_size) % 5')}) as p_type,
             p_size,
             concat({pick('SM|LG|MED|JUMBO|WRAP', '(p_partkey + p_size) % 5')}, ' ',
                    {pick('CASE|BOX|BAG|JAR|PACK|PKG|CAN|DRUM', '(p_partkey*3 + p_size) % 8')}) as p_container,
             cast(p_retailprice as decimal(12,2)) as p_retailprice, '' as p_comment
      from part""",
    "partsupp_h": """
      select pk as ps_partkey, sk as ps_suppkey,
             1 + (pk*31 + sk*17) % 9999 as ps_availqty,
             cast((100 + (pk*7919 + sk*104729) % 99901) / 100.0 as decimal(12,2)) as ps_supplycost,
             '' as ps_comment
      from (select distinct l_partkey as pk, l_suppkey as sk from lineitem) pairs""",
    "supplier_h": f"""
      select s_suppkey, s_name, concat('addr ', cast((s_suppkey*37) % 1000 as varchar)) as s_address,
             s_nationkey, {_phone('s_suppkey', 's_nationkey')} as s_phone,
             cast(s_acctbal as decimal(12,2)) as s_acctbal,
             case s_suppkey % 25 when 7 then 'slow Customer service Complaints'
                                 when 8 then 'good Customer service Recommends'
                  else concat('quiet deposits ', cast(s_suppkey % 11 as varchar)) end as s_comment
      from supplier""",
    "customer_h": f"""
      select c_custkey, c_name, concat('addr ', cast((c_custkey*41) % 1000 as varchar)) as c_address,
             c_nationkey, {_phone('c_custkey', 'c_nationkey')} as c_phone,
             cast(c_acctbal as decimal(12,2)) as c_acctbal, c_mktsegment,
             concat('final accounts ', cast(c_custkey % 13 as varchar)) as c_comment
      from customer""",
    "orders_h": f"""
      select o_orderkey, o_custkey, o_orderstatus,
             cast(o_totalprice as decimal(12,2)) as o_totalprice,
             cast(o_orderdate as date) as o_orderdate, o_orderpriority,
             concat('Clerk#', lpad(cast(1 + o_orderkey % 1000 as varchar), 9, '0')) as o_clerk,
             0 as o_shippriority,
             concat({pick('special|pending|unusual|express|regular|even', 'o_orderkey % 6')}, ' ',
                    {pick('packages|requests|accounts|deposits', '(o_orderkey + o_custkey) % 4')},
                    ' sleep') as o_comment
      from orders""",
}


def with_views(body: str, *names: str, extra: str = "") -> str:
    parts = [f"{name} as ({VIEWS[name]})" for name in VIEWS if name in names]
    if extra:
        parts.append(extra)
    return f"with {', '.join(parts)} {body}" if parts else body
