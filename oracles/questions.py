"""SQL for the twenty-two questions, with the test parameter values filled in."""

from __future__ import annotations

from oracles.views import with_views

REV = "l_extendedprice * (1 - l_discount)"


def questions() -> dict[str, str]:
    return {
        "q01_pricing_summary": with_views(f"""
            select l_returnflag, l_linestatus,
                   cast(sum(l_quantity) as double) as sum_qty,
                   cast(sum(l_extendedprice) as double) as sum_base_price,
                   cast(sum({REV}) as double) as sum_disc_price,
                   cast(sum({REV} * (1 + l_tax)) as double) as sum_charge,
                   cast(sum(l_quantity) as double) / count(*) as avg_qty,
                   cast(sum(l_extendedprice) as double) / count(*) as avg_price,
                   cast(sum(l_discount) as double) / count(*) as avg_disc,
                   count(*) as count_order
            from lineitem_h where l_shipdate <= date '1998-09-02'
            group by all order by 1, 2""", "lineitem_h"),
        "q02_min_cost_supplier": with_views("""
            select cast(s_acctbal as double) as s_acctbal, s_name, n_name, p_partkey, p_mfgr,
                   s_address, s_phone, s_comment
            from offers where ps_supplycost = low
            order by s_acctbal desc, n_name, s_name, p_partkey, s_suppkey limit 100""",
            "part_h", "partsupp_h", "supplier_h", extra="""
            offers as (
              select *, min(ps_supplycost) over (partition by p_partkey) as low
              from partsupp_h
              join part_h on ps_partkey = p_partkey
              join supplier_h on ps_suppkey = s_suppkey
              join nation on s_nationkey = n_nationkey
              join region on n_regionkey = r_regionkey
              where r_name = 'EUROPE' and p_size = 15 and p_type like '%BRASS')"""),
        "q03_shipping_priority": with_views(f"""
            select l_orderkey, cast(sum({REV}) as double) as revenue, o_orderdate, o_shippriority
            from lineitem_h join orders_h on l_orderkey = o_orderkey
                 join customer on c_custkey = o_custkey
            where c_mktsegment = 'BUILDING' and o_orderdate < date '1998-03-15'
              and l_shipdate > date '1998-03-15'
            group by l_orderkey, o_orderdate, o_shippriority
            order by sum({REV}) desc, o_orderdate, l_orderkey limit 10""",
            "lineitem_h", "orders_h"),
        "q04_order_priority": with_views("""
            select o_orderpriority, count(*) as order_count from orders_h
            where o_orderdate >= date '1996-07-01' and o_orderdate < date '1996-10-01'
              and o_orderkey in (select l_orderkey from lineitem_h
                                 where l_commitdate < l_receiptdate)
            group by o_orderpriority order by 1""", "lineitem_h", "orders_h"),
        "q05_local_supplier_volume": with_views(f"""
            select n_name, cast(sum({REV}) as double) as revenue
            from lineitem_h
            join orders_h on l_orderkey = o_orderkey
            join customer on o_custkey = c_custkey
            join supplier on l_suppkey = s_suppkey and s_nationkey = c_nationkey
            join nation on s_nationkey = n_nationkey
            join region on n_regionkey = r_regionkey
            where r_name = 'ASIA' and year(o_orderdate) = 1996
            group by n_name order by revenue desc""", "lineitem_h", "orders_h"),
        "q06_forecast_revenue": with_views("""
            select cast(sum(l_extendedprice * l_discount) as double) as revenue from lineitem_h
            where year(l_shipdate) = 1996 and l_discount between 0.05 and 0.07
              and l_quantity < 24""", "lineitem_h"),
        "q07_volume_shipping": with_views(f"""
            select n1.n_name as supp_nation, n2.n_name as cust_nation,
                   cast(year(l_shipdate) as int) as l_year, cast(sum({REV}) as double) as revenue
            from lineitem_h
            join orders on l_orderkey = o_orderkey
            join customer on o_custkey = c_custkey
            join supplier on l_suppkey = s_suppkey
            join nation n1 on s_nationkey = n1.n_nationkey
            join nation n2 on c_nationkey = n2.n_nationkey
            where year(l_shipdate) in (1995, 1996)
              and (n1.n_name, n2.n_name) in (('NATION_6', 'NATION_7'), ('NATION_7', 'NATION_6'))
            group by all order by 1, 2, 3""", "lineitem_h"),
        "q08_market_share": market_share(),
        "q09_product_profit": with_views(f"""
            select n_name as nation, cast(year(o_orderdate) as int) as o_year,
                   cast(sum({REV} - ps_supplycost * l_quantity) as double) as sum_profit
            from lineitem_h
            join part_h on l_partkey = p_partkey
            join partsupp_h on l_partkey = ps_partkey and l_suppkey = ps_suppkey
            join orders_h on l_orderkey = o_orderkey
            join supplier on l_suppkey = s_suppkey
            join nation on s_nationkey = n_nationkey
            where p_name like '%blue%'
            group by all order by 1, 2 desc""",
            "lineitem_h", "part_h", "partsupp_h", "orders_h"),
        "q10_returned_items": with_views(f"""
            select c_custkey, c_name, cast(sum({REV}) as double) as revenue,
                   cast(c_acctbal as double) as c_acctbal, n_name, c_address, c_phone, c_comment
            from customer_h
            join orders_h on c_custkey = o_custkey
            join lineitem_h on l_orderkey = o_orderkey
            join nation on c_nationkey = n_nationkey
            where o_orderdate >= date '1996-10-01' and o_orderdate < date '1997-01-01'
              and l_returnflag = 'R'
            group by c_custkey, c_name, customer_h.c_acctbal, n_name, c_address, c_phone, c_comment
            order by sum({REV}) desc, c_custkey limit 20""",
            "lineitem_h", "orders_h", "customer_h"),
        "q11_important_stock": with_views("""
            select ps_partkey, cast(v as double) as value from stock
            where v > (select sum(v) from stock) * 0.001
            order by value desc, ps_partkey""", "partsupp_h", extra="""
            stock as (
              select ps_partkey, sum(ps_supplycost * ps_availqty) as v
              from partsupp_h join supplier on ps_suppkey = s_suppkey
                   join nation on s_nationkey = n_nationkey
              where n_name = 'NATION_7' group by ps_partkey)"""),
        "q12_shipping_modes": shipping_modes(),
        "q13_customer_distribution": customer_distribution("c_count"),
        "q14_promotion_effect": promotion_effect(),
        "q15_top_supplier": top_supplier(),
        "q16_parts_supplier": with_views("""
            select p_brand, p_type, p_size, count(distinct ps_suppkey) as supplier_cnt
            from partsupp_h join part_h on p_partkey = ps_partkey
            where p_brand <> 'Brand#14' and p_type not like 'MEDIUM POLISHED%'
              and p_size in (49, 14, 23, 45, 19, 3, 36, 9)
              and ps_suppkey not in (select s_suppkey from supplier_h
                                     where s_comment like '%Customer%Complaints%')
            group by all order by supplier_cnt desc, 1, 2, 3""",
            "partsupp_h", "part_h", "supplier_h"),
        "q17_small_quantity": with_views("""
            select cast(sum(l_extendedprice) as double) / 7.0 as avg_yearly
            from lineitem_h join part_h on l_partkey = p_partkey
                 join (select l_partkey as k, sum(l_quantity) as q, count(*) as n
                       from lineitem_h group by l_partkey) totals on k = p_partkey
            where p_brand = 'Brand#23' and p_container = 'MED BOX'
              and 5 * n * l_quantity < q""", "lineitem_h", "part_h"),
        "q18_large_orders": with_views("""
            select c_name, c_custkey, o_orderkey, o_orderdate,
                   cast(o_totalprice as double) as o_totalprice,
                   cast(sum(l_quantity) as double) as sum_qty
            from customer join orders_h on c_custkey = o_custkey
                 join lineitem_h on o_orderkey = l_orderkey
            where o_orderkey in (select l_orderkey from lineitem_h group by l_orderkey
                                 having sum(l_quantity) > 250)
            group by c_name, c_custkey, o_orderkey, o_orderdate, orders_h.o_totalprice
            order by orders_h.o_totalprice desc, o_orderdate, o_orderkey limit 100""",
            "lineitem_h", "orders_h"),
        "q19_discounted_revenue": with_views(f"""
            select cast(sum({REV}) as double) as revenue
            from lineitem_h join part_h on p_partkey = l_partkey
            where l_shipmode in ('AIR', 'AIR REG') and l_shipinstruct = 'DELIVER IN PERSON'
              and ((p_brand = 'Brand#9' and l_quantity between 1 and 11 and p_size between 1 and 5
                    and p_container in ('SM CASE', 'SM BOX', 'SM PACK', 'SM PKG'))
                or (p_brand = 'Brand#3' and l_quantity between 15 and 25 and p_size between 1 and 10
                    and p_container in ('MED BAG', 'MED BOX', 'MED PKG', 'MED PACK'))
                or (p_brand = 'Brand#24' and l_quantity between 5 and 15 and p_size between 1 and 15
                    and p_container in ('LG CASE', 'LG BOX', 'LG PACK', 'LG PKG')))""",
            "lineitem_h", "part_h"),
        "q20_part_promotion": with_views("""
            select distinct s_name, s_address
            from supplier_h join nation on s_nationkey = n_nationkey
                 join partsupp_h on ps_suppkey = s_suppkey
                 join part_h on ps_partkey = p_partkey
                 join (select l_partkey as pk, l_suppkey as sk, sum(l_quantity) as q
                       from lineitem_h where year(l_shipdate) = 1996 group by all) shipped
                   on pk = ps_partkey and sk = ps_suppkey
            where n_name = 'NATION_3' and p_name like 'blue%' and ps_availqty > 0.5 * q
            order by s_name""",
            "lineitem_h", "part_h", "partsupp_h", "supplier_h"),
        "q21_waiting_suppliers": with_views("""
            select s_name, count(*) as numwait
            from lineitem_h l1 join orders on o_orderkey = l1.l_orderkey
                 join supplier on s_suppkey = l1.l_suppkey
                 join nation on s_nationkey = n_nationkey
            where o_orderstatus = 'F' and n_name = 'NATION_7'
              and l1.l_receiptdate > l1.l_commitdate
              and exists (select 1 from lineitem_h l2 where l2.l_orderkey = l1.l_orderkey
                          and l2.l_suppkey <> l1.l_suppkey)
              and not exists (select 1 from lineitem_h l3 where l3.l_orderkey = l1.l_orderkey
                              and l3.l_suppkey <> l1.l_suppkey
                              and l3.l_receiptdate > l3.l_commitdate)
            group by s_name order by numwait desc, s_name limit 100""", "lineitem_h"),
        "q22_global_sales": global_sales(""),
        "q22_global_sales_since": global_sales("and o_orderdate >= date '2001-01-01'"),
        "q08a_market_share": market_share(),
        "q12a_shipping_modes": shipping_modes(),
        "q13a_customer_distribution": customer_distribution("ordercount"),
        "q14a_promotion_effect": promotion_effect(),
        "q15a_top_supplier": top_supplier(),
    }


def global_sales(condition: str) -> str:
    return with_views(f"""
        select left(c_phone, 2) as cntrycode, count(*) as numcust,
               cast(sum(c_acctbal) as double) as totacctbal
        from customer_h
        where left(c_phone, 2) in ('13', '31', '23', '29', '30', '18', '17')
          and c_acctbal * (select count(*) from rich) > (select sum(c_acctbal) from rich)
          and not exists (select 1 from orders where o_custkey = c_custkey {condition})
        group by 1 order by 1""", "customer_h", extra="""
        rich as (select c_acctbal from customer_h where c_acctbal > 0
                 and left(c_phone, 2) in ('13', '31', '23', '29', '30', '18', '17'))""")


def market_share() -> str:
    return with_views(f"""
        select cast(year(o_orderdate) as int) as o_year,
               round(cast(sum(case when n2.n_name = 'NATION_2' then {REV} else 0 end) as double)
                     / cast(sum({REV}) as double), 6) as mkt_share
        from lineitem_h
        join part_h on l_partkey = p_partkey
        join orders_h on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join nation n1 on c_nationkey = n1.n_nationkey
        join region on n1.n_regionkey = r_regionkey
        join supplier on l_suppkey = s_suppkey
        join nation n2 on s_nationkey = n2.n_nationkey
        where r_name = 'AMERICA' and p_type = 'ECONOMY ANODIZED STEEL'
          and year(o_orderdate) in (1995, 1996)
        group by 1 order by 1""", "lineitem_h", "part_h", "orders_h")


def shipping_modes() -> str:
    return with_views("""
        select l_shipmode,
               cast(count(*) filter (o_orderpriority in ('1-URGENT', '2-HIGH')) as bigint)
                 as high_line_count,
               cast(count(*) filter (o_orderpriority not in ('1-URGENT', '2-HIGH')) as bigint)
                 as low_line_count
        from orders join lineitem_h on o_orderkey = l_orderkey
        where l_shipmode in ('MAIL', 'SHIP') and l_shipdate < l_commitdate
          and l_commitdate < l_receiptdate and year(l_receiptdate) = 1996
        group by l_shipmode order by 1""", "lineitem_h")


def customer_distribution(name: str) -> str:
    return with_views(f"""
        select n as {name}, count(*) as custdist
        from (select c_custkey, count(o_orderkey) as n
              from customer left join orders_h
                on c_custkey = o_custkey and o_comment not like '%special%requests%'
              group by c_custkey) counts
        group by n order by custdist desc, n desc""", "orders_h")


def promotion_effect() -> str:
    return with_views(f"""
        select round(cast(sum(case when p_type like 'PROMO%' then {REV} else 0 end) as double) * 100
                     / cast(sum({REV}) as double), 6) as promo_revenue
        from lineitem_h join part_h on l_partkey = p_partkey
        where l_shipdate >= date '1995-09-01' and l_shipdate < date '1995-10-01'""",
        "lineitem_h", "part_h")


def top_supplier() -> str:
    return with_views("""
        select s_suppkey, s_name, s_address, s_phone, cast(total as double) as total_revenue
        from supplier_h join revenue on s_suppkey = l_suppkey
        where total = (select max(total) from revenue) order by s_suppkey""",
        "lineitem_h", "supplier_h", extra=f"""
        revenue as (select l_suppkey, sum({REV}) as total from lineitem_h
                    where l_shipdate >= date '1996-01-01' and l_shipdate < date '1996-04-01'
                    group by l_suppkey)""")
