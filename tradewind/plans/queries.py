"""The twenty-two questions as DataFrame plans.

Common rules, so that a plan holds when the data grows and one key is hot:

* fact rows are summed by key *before* they are shuffled to a join, so the
  join sees one row per key and cannot be skewed by it;
* EXISTS / IN / NOT EXISTS become semi and anti joins against distinct keys;
* self-joins and correlated subqueries become one aggregate per key;
* no broadcast hints: Catalyst broadcasts a side only when its measured size
  is below the session's threshold, and adaptive execution splits skewed
  partitions of the remaining sort-merge joins;
* money is summed exactly in whole units and turned into DOUBLE once.
"""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.money import CHARGE, REVENUE, cents, exact_sum, money, ratio
from tradewind.operators.joins import null_aware_anti
from tradewind.sources.tables import Catalog

col, expr = F.col, F.expr


def months_after(day: date, months: int) -> date:
    years, month = divmod(day.month - 1 + months, 12)
    return day.replace(year=day.year + years, month=month + 1)


def _day(day: date) -> str:
    return f"date'{day.isoformat()}'"


def _within(column: str, start: date, months: int) -> str:
    return f"{column} >= {_day(start)} and {column} < {_day(months_after(start, months))}"


def _meet(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    return left.join(right, expr(on), how)


def _nations_in(c: Catalog, region: str) -> DataFrame:
    chosen = c.region.filter(col("r_name") == region)
    return _meet(c.nation, chosen, "n_regionkey = r_regionkey", "left_semi").select(
        "n_nationkey", "n_name")


def _suppliers_of(c: Catalog, nation: str) -> DataFrame:
    chosen = c.nation.filter(col("n_name") == nation)
    return _meet(c.supplier, chosen, "s_nationkey = n_nationkey", "left_semi")


def _total(units: str, name: str) -> Column:
    return expr(f"{exact_sum(units)} as {name}")


def pricing_sums(lines: DataFrame, days: int) -> DataFrame:
    """Per flag and status, in exact units, the sums over lines shipped up to ``days`` before December 1998."""
    last = date(1998, 12, 1) - timedelta(days=days)
    return (
        lines.filter(f"l_shipdate <= {_day(last)}")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(expr(f"sum({cents('l_quantity')}) as quantity"),
             _total(cents("l_extendedprice"), "price"), _total(REVENUE, "revenue"),
             _total(CHARGE, "charge"), expr(f"sum({cents('l_discount')}) as discount"),
             expr("count(*) as count_order")))


def pricing_report(sums: DataFrame) -> DataFrame:
    return sums.selectExpr(
        "l_returnflag", "l_linestatus",
        f"{money('quantity', 2)} as sum_qty", f"{money('price', 2)} as sum_base_price",
        f"{money('revenue', 4)} as sum_disc_price", f"{money('charge', 6)} as sum_charge",
        f"{money('quantity', 2)} / count_order as avg_qty",
        f"{money('price', 2)} / count_order as avg_price",
        f"{money('discount', 2)} / count_order as avg_disc",
        "count_order").orderBy("l_returnflag", "l_linestatus")


def q01(c: Catalog, days: int) -> DataFrame:
    """Pricing summary of lines shipped up to ``days`` before December 1998."""
    return pricing_report(pricing_sums(c.lineitem, days))


def q02(c: Catalog, size: int, metal: str, region: str) -> DataFrame:
    """Cheapest suppliers of a region for parts of one size and metal."""
    parts = c.part.filter((col("p_size") == size) & col("p_type").endswith(metal)).select(
        "p_partkey", "p_mfgr")
    suppliers = _meet(c.supplier, _nations_in(c, region), "s_nationkey = n_nationkey")
    # Narrow rows decide which offers win; the wide columns join the winners only.
    offers = _meet(
        _meet(c.partsupp.select("ps_partkey", "ps_suppkey", "ps_supplycost"), parts,
              "ps_partkey = p_partkey", "left_semi"),
        suppliers.select("s_suppkey"), "ps_suppkey = s_suppkey", "left_semi")
    # A part has at most one offer per supplier of the region.
    low = expr("min(ps_supplycost) over (partition by ps_partkey)")
    winners = offers.withColumn("low", low).filter("ps_supplycost = low")
    return (
        _meet(_meet(winners, parts, "ps_partkey = p_partkey"), suppliers,
              "ps_suppkey = s_suppkey")
        .orderBy(col("s_acctbal").desc(), "n_name", "s_name", "p_partkey", "s_suppkey")
        .limit(100)
        .select("s_acctbal", "s_name", "n_name", "p_partkey", "p_mfgr", "s_address",
                "s_phone", "s_comment"))


def q03(c: Catalog, segment: str, day: date) -> DataFrame:
    """Ten largest open orders of a market segment."""
    buyers = c.customer.filter(col("c_mktsegment") == segment)
    orders = _meet(
        c.orders.filter(f"o_orderdate < {_day(day)}")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_shippriority"),
        buyers, "o_custkey = c_custkey", "left_semi")
    unshipped = (c.lineitem.filter(f"l_shipdate > {_day(day)}")
                 .groupBy("l_orderkey").agg(_total(REVENUE, "units")))
    return (
        _meet(unshipped, orders, "l_orderkey = o_orderkey")
        .orderBy(col("units").desc(), "o_orderdate", "l_orderkey").limit(10)
        .selectExpr("l_orderkey", f"{money('units', 4)} as revenue", "o_orderdate",
                    "o_shippriority"))


def q04(c: Catalog, start: date) -> DataFrame:
    """Orders of a quarter with at least one late line, per priority."""
    late = c.lineitem.filter("l_commitdate < l_receiptdate").select("l_orderkey").distinct()
    return (
        _meet(c.orders.filter(_within("o_orderdate", start, 3)), late,
              "o_orderkey = l_orderkey", "left_semi")
        .groupBy("o_orderpriority").agg(expr("count(*) as order_count"))
        .orderBy("o_orderpriority"))


def q05(c: Catalog, region: str, start: date) -> DataFrame:
    """Revenue per nation where customer and supplier share the nation."""
    nations = _nations_in(c, region)
    buyers = _meet(c.customer.select("c_custkey", "c_nationkey"), nations,
                   "c_nationkey = n_nationkey", "left_semi")
    orders = _meet(
        c.orders.filter(_within("o_orderdate", start, 12)).select("o_orderkey", "o_custkey"),
        buyers, "o_custkey = c_custkey")
    sold = (
        _meet(c.lineitem.selectExpr("l_orderkey", "l_suppkey", f"{REVENUE} as u"), orders,
              "l_orderkey = o_orderkey")
        .groupBy("l_suppkey", "c_nationkey").agg(_total("u", "units")))
    local = _meet(sold, c.supplier.select("s_suppkey", "s_nationkey"),
                  "l_suppkey = s_suppkey and c_nationkey = s_nationkey")
    return (
        _meet(local, nations, "s_nationkey = n_nationkey")
        .groupBy("n_name").agg(expr(f"{money('sum(units)', 4)} as revenue"))
        .orderBy(col("revenue").desc(), "n_name"))


def q06(c: Catalog, start: date, discount: Decimal, quantity: int) -> DataFrame:
    """Revenue gained by dropping one discount band for small quantities."""
    low, high = float(discount - Decimal("0.01")), float(discount + Decimal("0.01"))
    units = f"{cents('l_extendedprice')} * {cents('l_discount')}"
    return (
        c.lineitem.filter(_within("l_shipdate", start, 12))
        .filter(col("l_discount").between(low, high) & (col("l_quantity") < float(quantity)))
        .agg(expr(f"{money(exact_sum(units), 4)} as revenue")))


def q07(c: Catalog, nation_a: str, nation_b: str) -> DataFrame:
    """Yearly trade between two nations, in both directions."""
    pair = c.nation.filter(col("n_name").isin(nation_a, nation_b))
    suppliers = _meet(c.supplier, pair, "s_nationkey = n_nationkey").selectExpr(
        "s_suppkey", "n_name as supp_nation")
    buyers = _meet(c.customer, pair, "c_nationkey = n_nationkey").selectExpr(
        "c_custkey", "n_name as cust_nation")
    orders = _meet(c.orders.select("o_orderkey", "o_custkey"), buyers, "o_custkey = c_custkey")
    lines = _meet(
        c.lineitem.filter("l_shipdate between date'1995-01-01' and date'1996-12-31'")
        .selectExpr("l_orderkey", "l_suppkey", "year(l_shipdate) as l_year", f"{REVENUE} as u"),
        suppliers, "l_suppkey = s_suppkey")
    return (
        _meet(lines, orders, "l_orderkey = o_orderkey and supp_nation <> cust_nation")
        .groupBy("supp_nation", "cust_nation", "l_year")
        .agg(expr(f"{money(exact_sum('u'), 4)} as revenue"))
        .orderBy("supp_nation", "cust_nation", "l_year"))


def market_volume(c: Catalog, region: str, ptype: str) -> DataFrame:
    """Revenue per order year and supplier nation for one part type in a region."""
    parts = c.part.filter(col("p_type") == ptype)
    buyers = _meet(c.customer, _nations_in(c, region), "c_nationkey = n_nationkey", "left_semi")
    orders = _meet(
        c.orders.filter("o_orderdate between date'1995-01-01' and date'1996-12-31'")
        .selectExpr("o_orderkey", "o_custkey", "year(o_orderdate) as o_year"),
        buyers, "o_custkey = c_custkey", "left_semi")
    lines = _meet(
        c.lineitem.selectExpr("l_orderkey", "l_partkey", "l_suppkey", f"{REVENUE} as u"),
        parts, "l_partkey = p_partkey", "left_semi")
    sold = (_meet(lines, orders, "l_orderkey = o_orderkey")
            .groupBy("l_suppkey", "o_year").agg(_total("u", "volume")))
    return (
        _meet(_meet(sold, c.supplier, "l_suppkey = s_suppkey"), c.nation,
              "s_nationkey = n_nationkey")
        .selectExpr("o_year", "n_name as nation", "volume"))


def q08(c: Catalog, nation: str, region: str, ptype: str) -> DataFrame:
    """Market share of one nation within a region, per year."""
    own = F.when(col("nation") == nation, col("volume")).otherwise(0)
    return (
        market_volume(c, region, ptype).withColumn("own", own)
        .groupBy("o_year").agg(expr(f"{ratio('sum(own)', 'sum(volume)')} as mkt_share"))
        .orderBy("o_year"))


def q09(c: Catalog, word: str) -> DataFrame:
    """Profit per supplier nation and year on parts whose name holds a word."""
    parts = c.part.filter(col("p_name").contains(word))
    orders = c.orders.selectExpr("o_orderkey", "year(o_orderdate) as o_year")
    lines = _meet(
        c.lineitem.selectExpr("l_orderkey", "l_partkey", "l_suppkey",
                              f"{cents('l_quantity')} as q", f"{REVENUE} as u"),
        parts, "l_partkey = p_partkey", "left_semi")
    sold = (
        _meet(lines, orders, "l_orderkey = o_orderkey")
        .groupBy("l_partkey", "l_suppkey", "o_year")
        .agg(_total("u", "units"), expr("sum(q) as quantity")))
    stock = _meet(c.partsupp, parts, "ps_partkey = p_partkey", "left_semi").selectExpr(
        "ps_partkey", "ps_suppkey", f"{cents('ps_supplycost')} as cost")
    costed = _meet(sold, stock, "l_partkey = ps_partkey and l_suppkey = ps_suppkey")
    by_nation = _meet(_meet(costed, c.supplier, "l_suppkey = s_suppkey"), c.nation,
                      "s_nationkey = n_nationkey")
    profit = "sum(units - cast(cost as decimal(18,0)) * cast(quantity as decimal(19,0)))"
    return (
        by_nation.groupBy(col("n_name").alias("nation"), "o_year")
        .agg(expr(f"{money(profit, 4)} as sum_profit"))
        .orderBy("nation", col("o_year").desc()))


def q10(c: Catalog, start: date) -> DataFrame:
    """Twenty customers who lost the most revenue to returns in a quarter."""
    returned = (c.lineitem.filter("l_returnflag = 'R'")
                .groupBy("l_orderkey").agg(_total(REVENUE, "u")))
    lost = (
        _meet(c.orders.filter(_within("o_orderdate", start, 3)).select("o_orderkey", "o_custkey"),
              returned, "o_orderkey = l_orderkey")
        .groupBy("o_custkey").agg(expr("sum(u) as units")))
    # Rank on narrow rows; the wide customer columns are read for twenty rows only.
    placed = _meet(lost, c.customer.selectExpr("c_custkey as k", "c_nationkey as home"),
                   "o_custkey = k")
    top = (
        _meet(placed, c.nation, "home = n_nationkey").select("k", "units", "n_name")
        .orderBy(col("units").desc(), "k").limit(20))
    return (
        _meet(c.customer, top, "c_custkey = k")
        .orderBy(col("units").desc(), "c_custkey")
        .selectExpr("c_custkey", "c_name", f"{money('units', 4)} as revenue", "c_acctbal",
                    "n_name", "c_address", "c_phone", "c_comment"))


def q11(c: Catalog, nation: str, fraction: Decimal) -> DataFrame:
    """Parts holding more than a fraction of the nation's stock value."""
    stock = (
        _meet(c.partsupp, _suppliers_of(c, nation), "ps_suppkey = s_suppkey", "left_semi")
        .groupBy("ps_partkey")
        .agg(_total(f"{cents('ps_supplycost')} * ps_availqty", "units")))
    total = stock.agg(expr("sum(units) as total")).scalar()
    return (
        stock.filter(col("units") > total * F.lit(Decimal(fraction)))
        .selectExpr("ps_partkey", f"{money('units', 2)} as value")
        .orderBy(col("value").desc(), "ps_partkey"))


def late_mode_lines(c: Catalog, mode_a: str, mode_b: str, start: date) -> DataFrame:
    """Late lines of two ship modes, counted per order and mode, with the priority.

    Both counts are kept on one row per order, so that one shuffle by order key
    serves the aggregation and the join; the modes become rows after it.
    """
    lines = (
        c.lineitem.filter(col("l_shipmode").isin(mode_a, mode_b))
        .filter("l_commitdate < l_receiptdate and l_shipdate < l_commitdate")
        .filter(_within("l_receiptdate", start, 12))
        .groupBy("l_orderkey")
        .agg(F.count_if(col("l_shipmode") == mode_a).alias("a"),
             F.count_if(col("l_shipmode") == mode_b).alias("b")))
    counted = _meet(lines, c.orders.select("o_orderkey", "o_orderpriority"),
                    "l_orderkey = o_orderkey")
    return counted.select(
        "o_orderpriority", F.explode(F.create_map(
            F.lit(mode_a), col("a"), F.lit(mode_b), col("b"))).alias("l_shipmode", "n")
    ).filter("n > 0")


def q12(c: Catalog, mode_a: str, mode_b: str, start: date) -> DataFrame:
    """High and low priority line counts per ship mode."""
    high = "o_orderpriority in ('1-URGENT', '2-HIGH')"
    return (
        late_mode_lines(c, mode_a, mode_b, start).groupBy("l_shipmode")
        .agg(expr(f"sum(if({high}, n, 0)) as high_line_count"),
             expr(f"sum(if({high}, 0, n)) as low_line_count"))
        .orderBy("l_shipmode"))


def counted_orders(orders: DataFrame, first: str, second: str) -> DataFrame:
    """Per customer key the number of orders whose comment lacks two words."""
    return (
        orders.filter(~col("o_comment").like(f"%{first}%{second}%"))
        .groupBy("o_custkey").agg(expr("count(o_orderkey) as n")))


def with_all_customers(c: Catalog, counted: DataFrame) -> DataFrame:
    return (
        _meet(c.customer.select("c_custkey"), counted, "c_custkey = o_custkey", "left")
        .selectExpr("c_custkey", "coalesce(n, 0) as c_count"))


def orders_per_customer(c: Catalog, first: str, second: str) -> DataFrame:
    """Every customer with the number of orders whose comment lacks two words."""
    return with_all_customers(c, counted_orders(c.orders, first, second))


def histogram(counts: DataFrame) -> DataFrame:
    return counts.groupBy("c_count").agg(expr("count(*) as custdist")).orderBy(col("custdist").desc(), col("c_count").desc())


def q13(c: Catalog, first: str, second: str) -> DataFrame:
    """Histogram of orders per customer."""
    return histogram(orders_per_customer(c, first, second))


def month_revenue_by_part(c: Catalog, start: date) -> DataFrame:
    """Revenue of one month per part key, with the part's type."""
    sold = (c.lineitem.filter(_within("l_shipdate", start, 1))
            .groupBy("l_partkey").agg(_total(REVENUE, "units")))
    return _meet(sold, c.part.select("p_partkey", "p_type"), "l_partkey = p_partkey")


def q14(c: Catalog, start: date) -> DataFrame:
    """Share of a month's revenue that promotion parts bring, in percent."""
    promo = "sum(if(p_type like 'PROMO%', units, 0))"
    return month_revenue_by_part(c, start).agg(
        expr(f"{ratio(promo, 'sum(units)', 100)} as promo_revenue"))


def supplier_revenue(c: Catalog, start: date) -> DataFrame:
    """Revenue per supplier over three months; the null filter makes all its uses one exchange."""
    return (c.lineitem.filter(_within("l_shipdate", start, 3)).filter("l_suppkey is not null")
            .groupBy(col("l_suppkey").alias("supplier_no")).agg(_total(REVENUE, "units")))


def q15(c: Catalog, start: date) -> DataFrame:
    """The supplier or suppliers with the highest revenue; ties are kept."""
    revenue = supplier_revenue(c, start)
    best = revenue.agg(expr("max(units) as best")).scalar()
    return (
        _meet(c.supplier, revenue.filter(col("units") == best), "s_suppkey = supplier_no")
        .selectExpr("s_suppkey", "s_name", "s_address", "s_phone",
                    f"{money('units', 4)} as total_revenue")
        .orderBy("s_suppkey"))


def q16(c: Catalog, brand: str, ptype: str, sizes: tuple[int, ...]) -> DataFrame:
    """Suppliers per brand, type and size, leaving out those with complaints."""
    parts = (
        c.part.filter((col("p_brand") != brand) & ~col("p_type").startswith(ptype)
                      & col("p_size").isin(list(sizes)))
        .select("p_partkey", "p_brand", "p_type", "p_size"))
    blamed = c.supplier.filter("s_comment like '%Customer%Complaints%'")
    offers = _meet(c.partsupp.select("ps_partkey", "ps_suppkey"), parts, "ps_partkey = p_partkey")
    return (
        null_aware_anti(offers, blamed, "ps_suppkey", "s_suppkey")
        .groupBy("p_brand", "p_type", "p_size")
        .agg(expr("count(distinct ps_suppkey) as supplier_cnt"))
        .orderBy(col("supplier_cnt").desc(), "p_brand", "p_type", "p_size"))


def q17(c: Catalog, brand: str, container: str) -> DataFrame:
    """Yearly revenue of orders far below a part's average quantity."""
    parts = c.part.filter((col("p_brand") == brand) & (col("p_container") == container))
    # Lines are counted per part and quantity before they meet the parts, so a hot part has one row per quantity.
    by_quantity = (
        c.lineitem.selectExpr("l_partkey", f"{cents('l_quantity')} as q", f"{cents('l_extendedprice')} as p")
        .groupBy("l_partkey", "q").agg(expr("count(*) as n"), _total("p", "price")))
    chosen = _meet(by_quantity, parts, "l_partkey = p_partkey", "left_semi")
    return (
        chosen.withColumns({"lines": expr("sum(n) over (partition by l_partkey)"),
                            "total": expr("sum(q * n) over (partition by l_partkey)")})
        .filter("q * 5 * lines < total")
        .agg(expr(f"{money('sum(price)', 2)} / 7D as avg_yearly")))


def large_totals(lines: DataFrame, quantity: int) -> DataFrame:
    """Order keys above a total quantity, with it in hundredths."""
    return (
        lines.groupBy("l_orderkey").agg(expr(f"sum({cents('l_quantity')}) as q"))
        .filter(col("q") > quantity * 100))


def large_orders(orders: DataFrame, large: DataFrame) -> DataFrame:
    """The orders that ``large_totals`` names."""
    return _meet(orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"),
                 large, "o_orderkey = l_orderkey").drop("l_orderkey")


def hundred_largest(c: Catalog, orders: DataFrame) -> DataFrame:
    return (
        _meet(orders, c.customer.select("c_custkey", "c_name"), "o_custkey = c_custkey")
        .orderBy(col("o_totalprice").desc(), "o_orderdate", "o_orderkey").limit(100)
        .selectExpr("c_name", "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice",
                    f"{money('q', 2)} as sum_qty"))


def q18(c: Catalog, quantity: int) -> DataFrame:
    """Hundred largest orders by price among those above a total quantity."""
    return hundred_largest(c, large_orders(c.orders, large_totals(c.lineitem, quantity)))


def q19(c: Catalog, brands: tuple[str, ...], quantities: tuple[int, ...]) -> DataFrame:
    """Revenue of hand-delivered air lines for three brand/container/size clauses.

    Containers tell the clauses apart, so a part meets one at most.  Lines are
    summed per part with one sum per quantity range; the part picks its sum.
    """
    # Containers and the largest size of each clause.
    containers = (["SM CASE", "SM BOX", "SM PACK", "SM PKG"],
                  ["MED BAG", "MED BOX", "MED PKG", "MED PACK"],
                  ["LG CASE", "LG BOX", "LG PACK", "LG PKG"])
    sizes = (5, 10, 15)
    clauses = [
        (col("p_brand") == brand) & col("p_container").isin(kinds) & col("p_size").between(1, size)
        for brand, kinds, size in zip(brands, containers, sizes)]
    ranges = [f"l_quantity between {int(low)} and {int(low) + 10}" for low in quantities]
    lines = (
        c.lineitem.filter("l_shipmode in ('AIR', 'AIR REG')"
                          " and l_shipinstruct = 'DELIVER IN PERSON'")
        .filter(" or ".join(ranges)).groupBy("l_partkey")
        .agg(*[_total(f"if({r}, {REVENUE}, null)", f"u{i}") for i, r in enumerate(ranges)]))
    parts = c.part.select("p_partkey", *[
        clause.alias(f"c{i}") for i, clause in enumerate(clauses)]).filter("c0 or c1 or c2")
    return (
        _meet(lines, parts, "l_partkey = p_partkey")
        .selectExpr("case when c0 then u0 when c1 then u1 else u2 end as units")
        .agg(expr(f"{money('sum(units)', 4)} as revenue")))


def q20(c: Catalog, word: str, start: date, nation: str) -> DataFrame:
    """Suppliers of a nation with excess stock of parts named by a prefix."""
    parts = c.part.filter(col("p_name").startswith(word)).select("p_partkey")
    # Summed per offer before any join: a hot part is one row per supplier.
    shipped = (
        c.lineitem.filter(_within("l_shipdate", start, 12))
        .selectExpr("l_partkey", "l_suppkey", f"{cents('l_quantity')} as amount")
        .groupBy("l_partkey", "l_suppkey").agg(expr("sum(amount) as q")))
    stock = _meet(c.partsupp.select("ps_partkey", "ps_suppkey", "ps_availqty"), parts,
                  "ps_partkey = p_partkey", "left_semi")
    excess = _meet(shipped, stock, "l_partkey = ps_partkey and l_suppkey = ps_suppkey"
                   " and ps_availqty * 200 > q").select("ps_suppkey").distinct()
    return (
        _meet(_suppliers_of(c, nation), excess, "s_suppkey = ps_suppkey", "left_semi")
        .select("s_name", "s_address").orderBy("s_name"))


def q21(c: Catalog, nation: str) -> DataFrame:
    """Suppliers who alone kept multi-supplier orders waiting.

    Least and greatest supplier key per order tell whether an order has several
    suppliers and whether all its late lines come from one: no self-join.
    """
    late = "if(l_receiptdate > l_commitdate, l_suppkey, null)"
    blamed = (
        c.lineitem.groupBy("l_orderkey")
        .agg(expr("min(l_suppkey) as least"), expr("max(l_suppkey) as greatest"),
             expr(f"min({late}) as suppkey"), expr(f"max({late}) as late_greatest"),
             expr(f"count({late}) as late_lines"))
        .filter("least <> greatest and suppkey = late_greatest"))
    closed = c.orders.filter("o_orderstatus = 'F'").select("o_orderkey")
    waiting = (
        _meet(blamed, closed, "l_orderkey = o_orderkey", "left_semi")
        .groupBy("suppkey").agg(expr("sum(late_lines) as lines")))
    return (
        _meet(_suppliers_of(c, nation).select("s_suppkey", "s_name"), waiting,
              "s_suppkey = suppkey")
        .groupBy("s_name").agg(expr("sum(lines) as numwait"))
        .orderBy(col("numwait").desc(), "s_name").limit(100))


def q22(c: Catalog, codes: tuple[str, ...], since: date | None = None) -> DataFrame:
    """Well-funded customers without orders, per country code.

    With ``since``, orders before that day do not count; by default any order counts.
    """
    orders = c.orders if since is None else c.orders.filter(f"o_orderdate >= {_day(since)}")
    people = (
        c.customer.selectExpr("c_custkey", "substring(c_phone, 1, 2) as cntrycode",
                              f"{cents('c_acctbal')} as bal")
        .filter(col("cntrycode").isin(list(codes))))
    # Balances are whole cents, so they exceed the average if they exceed its whole part.
    average = people.filter("bal > 0").agg(
        expr("sum(bal) div nullif(count(*), 0) as average")).scalar()
    return (
        _meet(people.filter(col("bal") > average), orders.select("o_custkey").distinct(),
              "c_custkey = o_custkey", "left_anti")
        .groupBy("cntrycode")
        .agg(expr("count(*) as numcust"), expr(f"{money('sum(bal)', 2)} as totacctbal"))
        .orderBy("cntrycode"))


QUERIES = {
    f"q{number:02d}": function
    for number, function in enumerate(
        (q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, q11,
         q12, q13, q14, q15, q16, q17, q18, q19, q20, q21, q22), start=1)
}


def run(catalog: Catalog, name: str, **params) -> DataFrame:
    """One question by name, for example ``run(catalog, "q06", **DEFAULTS["q06"])``."""
    return QUERIES[name](catalog, **params)
