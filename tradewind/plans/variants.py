"""Five alternative formulations, as SQL text with named parameters.

Each gives the rows of its base question.  Values are bound as parameters and
tables as DataFrames; nothing is pasted into the text.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from tradewind.plans import queries as Q
from tradewind.plans.queries import months_after
from tradewind.sources.tables import Catalog

MARKET_SHARE = """
    select o_year,
           round(try_divide(cast(sum(decode(nation, :nation, volume, 0)) as double),
                            cast(sum(volume) as double)), 6) as mkt_share
    from {volumes}
    group by o_year
    order by o_year
"""

SHIPPING_MODES = """
    select l_shipmode,
           sum(decode(o_orderpriority, '1-URGENT', n, '2-HIGH', n, 0)) as high_line_count,
           sum(decode(o_orderpriority, '1-URGENT', 0, '2-HIGH', 0, n)) as low_line_count
    from {lines}
    group by l_shipmode
    order by l_shipmode
"""

CUSTOMER_DISTRIBUTION = """
    select ordercount, count(*) as custdist
    from {orders_per_customer}
    group by ordercount
    order by custdist desc, ordercount desc
"""

PROMOTION_EFFECT = """
    select round(try_divide(
             100 * cast(sum(decode(substring(p_type, 1, 5), 'PROMO', units, 0)) as double),
             cast(sum(units) as double)), 6) as promo_revenue
    from {sold}
"""

TOP_SUPPLIER = """
    with revenue as (
      select l_suppkey as supplier_no,
             sum(cast(l_extendedprice as decimal(12, 2))
                 * (1 - cast(l_discount as decimal(12, 2)))) as total
      from {lineitem}
      where l_shipdate >= :first and l_shipdate < :after and l_suppkey is not null
      group by l_suppkey
    )
    select s_suppkey, s_name, s_address, s_phone, cast(total as double) as total_revenue
    from {supplier} join revenue on s_suppkey = supplier_no
    where total = (select max(total) from revenue)
    order by s_suppkey
"""


def q08a(c: Catalog, nation: str, region: str, ptype: str) -> DataFrame:
    """Market share, with ``decode`` picking the nation's volume."""
    return c.spark.sql(MARKET_SHARE, args={"nation": nation},
                       volumes=Q.market_volume(c, region, ptype))


def q12a(c: Catalog, mode_a: str, mode_b: str, start: date) -> DataFrame:
    """Shipping modes, with one multi-armed ``decode`` per column."""
    return c.spark.sql(SHIPPING_MODES, lines=Q.late_mode_lines(c, mode_a, mode_b, start))


def q13a(c: Catalog, first: str, second: str) -> DataFrame:
    """Customer distribution over a named view."""
    per_customer = Q.orders_per_customer(c, first, second).toDF("custkey", "ordercount")
    return c.spark.sql(CUSTOMER_DISTRIBUTION, orders_per_customer=per_customer)


def q14a(c: Catalog, start: date) -> DataFrame:
    """Promotion effect, with ``decode`` on the first five letters of the type."""
    return c.spark.sql(PROMOTION_EFFECT, sold=Q.month_revenue_by_part(c, start))


def q15a(c: Catalog, start: date) -> DataFrame:
    """Top supplier, with a common table expression for the revenue."""
    return c.spark.sql(TOP_SUPPLIER, args={"first": start, "after": months_after(start, 3)},
                       lineitem=c.lineitem, supplier=c.supplier)


VARIANTS = {"q08a": q08a, "q12a": q12a, "q13a": q13a, "q14a": q14a, "q15a": q15a}
BASE_OF = {name: name[:3] for name in VARIANTS}
