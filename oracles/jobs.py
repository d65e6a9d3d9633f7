"""SQL for the loading, layout, refresh, streaming and sweep reports."""

from __future__ import annotations

from oracles.checks import COLUMNS, KEYS, MONEY, NAMES, cardinalities, checks, source
from oracles.questions import REV, questions
from oracles.views import VIEWS, with_views

LINE_SUMMARY = with_views("""
    select l_returnflag, l_linestatus, count(*) as rows,
           cast(sum(l_extendedprice) as double) as price, min(l_shipdate) as first_ship,
           max(l_receiptdate) as last_receipt, count(distinct l_shipmode) as modes,
           count(*) as blank_comments
    from lineitem_h group by all""", "lineitem_h")

STEPS = with_views("""
    select step, count(*) as rows, min(o_orderkey) as first_key, max(o_orderkey) as last_key,
           cast(sum(o_totalprice) as double) as price
    from (select *, cast(least(4, (row_number() over (order by o_orderkey) - 1)
                               // greatest(1, (select count(*) from orders) // 4) + 1) as int) as step
          from orders_h)
    group by step""", "orders_h")

SETS = """
    members as (
      select o_orderkey as k, (row_number() over (order by o_orderkey) - 1)
             // greatest(1, (select count(*) from orders) // 1000) + 1 as refresh from orders),
    shift as (select max(o_orderkey) + 1 as s from orders)"""


def refreshed(inserted: int, deleted: int) -> str:
    """Status report after sets 1..inserted came in and sets 1..deleted went out."""
    def part(table: str, status: str, key: str) -> str:
        return f"""
          select '{table}' as table_name, {status} as status, count(*) as rows,
                 cast(sum(key) as bigint) as key_sum
          from (select {status}, {key} as key from {table}
                where {key} not in (select k from members where refresh <= {deleted})
                union all
                select {status}, {key} + s from {table} join members on k = {key}, shift
                where refresh <= {inserted})
          group by {status}"""
    return (f"with {SETS} {part('orders', 'o_orderstatus', 'o_orderkey')} union all "
            f"{part('lineitem', 'l_linestatus', 'l_orderkey')}")


def kept(question: str, sets: int) -> str:
    """A question over orders and lines after sets 1..sets came in and went out."""
    body = questions()[question]
    changed = lambda table, key: f"""
        {table}_now as (
          select * from {table}_h where {key} not in (select k from members where refresh <= {sets})
          union all
          select h.* replace ({key} + s as {key}) from {table}_h h join members on k = {key}, shift where refresh <= {sets})"""
    views = ", ".join(f"{name} as ({VIEWS[name]})" for name in ("lineitem_h", "orders_h"))
    select = body[body.rindex("select l_returnflag" if "pricing" in question else "select n as" if "distribution" in question else "select c_name"):]
    for table in ("lineitem", "orders"):
        select = select.replace(f"{table}_h", f"{table}_now")
    return f"with {views}, {SETS}, {changed('lineitem', 'l_orderkey')}, {changed('orders', 'o_orderkey')} {select}"


def step_keys() -> str:
    """Keys of the last step, repeated inside it and in earlier ones, and references without a parent."""
    tables = {"orders": ("o", "k1, k2", "select o_orderkey as k1, 0 as k2, o_orderkey % 4 as part from orders"),
              "lineitem": ("l", "k1, k2", "select k1, l_linenumber as k2, part from lines"),
              "partsupp": ("p", "k1, k2", "select distinct l_partkey as k1, l_suppkey as k2, l_partkey % 4 as part from lineitem")}
    reports = [f"""
        select 'primary key' as check_name, '{name}' as object_name, count(*) as keys, count(*) filter (n > 1) as violating_keys,
               count(*) filter ((k1, k2) in (select (k1, k2) from (select k1, k2 from ({rows}) x where part < 3))) as earlier_keys
        from (select k1, k2, count(*) as n from ({rows}) y where part = 3 group by 1, 2) z""" for name, (_, _, rows) in tables.items()]
    references = {"lineitem_orders": ("k1", "select o_orderkey from orders"),
                  "lineitem_partsupp": ("(l_partkey, l_suppkey)", "select (l_partkey, l_suppkey) from lineitem")}
    reports += [f"""
        select 'foreign key', '{name}', count(*), count(*) filter (k not in ({parents})), cast(0 as bigint)
        from (select distinct {key} as k from lines where part = 3) z""" for name, (key, parents) in references.items()]
    return f"""
        with lines as (
          select *, l_partkey % 4 as part,
                 case when l_partkey % 4 = 3 and l_quantity = 13 then l_orderkey + (select max(o_orderkey) + 1 from orders) else l_orderkey end as k1
          from lineitem) {' union all '.join(reports)}"""


def scan(table: str) -> str:
    integers = {"o_shippriority"}
    def column(name: str) -> str:
        if name in MONEY:
            return f"cast({name} as double) as {name}"
        if name == "l_linenumber":
            return "cast(l_linenumber as bigint) as l_linenumber"
        if name in integers:
            return f"cast({name} as int) as {name}"
        if name in ("r_comment", "n_comment"):
            return f"cast({name} as varchar) as {name}"
        return name
    return with_views(
        f"select {', '.join(column(c) for c in COLUMNS[table].split())} from {source(table)}",
        *NAMES)


def initial_load(counts: str) -> str:
    facts = " union all ".join(f"select 'layout', '{t}', count(*) from {t}" for t in ("lineitem", "orders"))
    return with_views(f"""
        select 'load' as stage, table_name as object_name, rows as value from ({counts})
        union all select 'primary key', table_name, cast(repeated_keys + null_keys as bigint) from ({checks()["check_primary_keys"]})
        union all select 'foreign key', constraint_name, cast(orphan_rows as bigint) from ({checks()["check_foreign_keys"]})
        union all {facts}""", *NAMES)


def jobs() -> dict[str, str]:
    counts = " union all ".join(
        f"select '{t}' as table_name, count(*) as rows from {source(t)}" for t in COLUMNS)
    return {
        **{f"scan_table_{t}": scan(t) for t in COLUMNS},
        "write_and_scan_flat_file": LINE_SUMMARY,
        "flat_file_rejects": """
            select case l_orderkey % 40 when 1 then '9 fields instead of 16' when 2 then 'l_quantity: no double'
                                        when 3 then 'l_orderkey: missing' else 'good' end as reason, count(*) as rows
            from lineitem group by 1""",
        "write_tab_copy": LINE_SUMMARY,
        "write_and_read_tab_dump": """
            select user_id as id, 1 + user_id % 5 as run,
                   case user_id % 3 when 0 then concat('load', cast(user_id as varchar))
                        when 1 then 'single-user-stream' else 'multi-user-stream' end as name,
                   min(ts) as start, cast(sum(cast(value as decimal(12,2))) as double) as duration,
                   case when user_id % 3 = 0
                        then concat(cast(user_id + 1 as varchar), '..', cast(user_id + 3 as varchar))
                   end as steps,
                   case when user_id % 3 = 0 then 0 else count(*) end as queries
            from events group by user_id""",
        "load_step_append": STEPS,
        "stream_step_ingest": STEPS,
        "initial_load": initial_load(counts),
        "check_step_keys": step_keys(),
        "locate_differences": """
            select o_orderkey, cast(1 as bigint) as in_first, cast(case o_orderkey % 1499 when 3 then 1 else 0 end as bigint) as in_second
            from orders where o_orderkey % 1499 in (3, 4)
            union all select -o_orderkey - 1, 0, 1 from orders where o_orderkey % 1499 = 5""",
        "warm_cache": cardinalities(),
        "drop_tables": with_views(f"select *, false as there from ({counts})", *NAMES),
        "analyze_tables": with_views(" union all ".join(
            f"select '{t}' as table_name, count(*) as rows, cast(min({KEYS[t].split(',')[0]}) as bigint) as least_key,"
            f" cast(max({KEYS[t].split(',')[0]}) as bigint) as greatest_key from {source(t)}" for t in COLUMNS), *NAMES),
        "cluster_layout": with_views(f"""
            select cast(year(l_shipdate) as int) as year, l_linestatus, count(*) as rows,
                   cast(sum({REV}) as double) as revenue
            from lineitem_h group by 1, 2""", "lineitem_h"),
        "zorder_layout": with_views(f"""
            select cast(year(l_shipdate) as int) as year, count(*) as rows, cast(sum({REV}) as double) as revenue
            from lineitem_h where l_discount between 0.02 and 0.03 and l_quantity < 10 group by 1""", "lineitem_h"),
        "colocated_join": with_views(f"""
            select o_orderpriority, count(distinct o_orderkey) as orders,
                   cast(sum({REV}) as double) as revenue
            from orders join lineitem_h on o_orderkey = l_orderkey group by 1""", "lineitem_h"),
        "colocated_hot_key": with_views(f"""
            select o_orderpriority, count(*) as lines, cast(sum({REV}) as double) as revenue
            from lineitem_h join orders
              on o_orderkey = case when l_orderkey % 10 < 3 then (select min(o_orderkey) from orders) else l_orderkey end
            group by 1""", "lineitem_h"),
        "colocated_parts": with_views("""
            select p_brand, count(*) as offers, cast(sum(ps_availqty) as bigint) as quantity
            from part join partsupp_h on p_partkey = ps_partkey group by p_brand""", "partsupp_h"),
        "null_aware_anti_join": """
            with buyers as (select c_custkey from customer where c_mktsegment = 'BUILDING'),
                 holed as (select case when c_custkey > 0 then c_custkey end as c_custkey from buyers
                           union all select null)
            select 'clean' as case_name, count(*) as rows from orders
              where o_custkey not in (select c_custkey from buyers)
            union all select 'with_null', count(*) from orders
              where o_custkey not in (select c_custkey from holed)
            union all select 'empty', count(*) from orders
              where o_custkey not in (select c_custkey from buyers where c_custkey < 0)""",
        "expand_step_range": """
            select event_id, text,
                   case event_id % 5 when 0 then text
                     when 1 then concat_ws(',', a, cast(n + 1 as varchar), cast(n + 2 as varchar), b)
                     else '' end as steps,
                   case event_id % 5 when 1 then (n + 3) * 3 when 3 then 6 when 4 then n * 3 end
                     as scale
            from (select event_id, event_id % 50 as n, cast(event_id % 50 as varchar) as a,
                         cast(event_id % 50 + 3 as varchar) as b,
                         case event_id % 5 when 0 then a when 1 then concat(a, '..', b)
                              when 2 then 'x' when 3 then '1..2..3' else concat(b, '..', a) end as text
                  from events)""",
        "rf1_insert": refreshed(1, 0),
        "rf2_delete": refreshed(0, 1),
        "stored_refresh_sets": refreshed(2, 2),
        "compact_refresh_sets": refreshed(3, 3),
        "kept_q01": kept("q01_pricing_summary", 3),
        "kept_q13": kept("q13_customer_distribution", 3),
        "kept_q18": kept("q18_large_orders", 3),
        "stream_refresh": refreshed(2, 2),
        "segmented_refresh": """
            with k as (select l_orderkey as key, count(*) as n from lineitem group by 1),
                 s as (select *, least(3, (row_number() over (order by key) - 1)
                                         // greatest(1, (select count(*) from k) // 3) + 1) as segment
                       from k)
            select cast(segment as int) as segment, count(*) as orders,
                   cast(sum(n) as bigint) as lines, min(key) as first_key, max(key) as last_key
            from s group by segment""",
        "stream_throughput": """
            with q as (select ts from events)
            select date_trunc('minute', ts) as window_start,
                   date_trunc('minute', ts) + interval 1 minute as window_end,
                   count(*) as queries, cast(count(*) as double) as qpm
            from q group by 1, 2""",
        "stream_job_reports": """
            with w as (
              select user_id as job, case when user_id % 3 = 0 then 5 else 60 end as seconds,
                     floor(epoch(ts) / case when user_id % 3 = 0 then 5 else 60 end)::bigint as slot,
                     count(*) filter (event_type = 'purchase') as streams, count(*) as queries
              from events group by all),
            t as (
              select *, make_timestamp(slot * seconds * 1000000) as window_start, make_timestamp((slot + 1) * seconds * 1000000) as window_end,
                     cast(sum(streams) over sofar as bigint) as all_streams, cast(sum(queries) over sofar as bigint) as all_queries,
                     (slot + 1 - min(slot) over sofar) * seconds as elapsed
              from w window sofar as (partition by job order by slot))
            select job, seconds, window_start, window_end, streams, queries, all_streams, all_queries, elapsed,
                   round(cast(all_queries * 60 as double) / elapsed, 6) as qpm
            from t""",
        "sweep_q06": with_views("""
            select cast((y - 1993) * 16 + (d - 2) * 2 + (q - 24) + 1 as int) as set_id,
                   cast(y as int) as year, cast(d as int) as discount, cast(q as int) as quantity,
                   cast(sum(l_extendedprice * l_discount) as double) as revenue
            from range(1993, 1998) years(y), range(2, 10) discounts(d), range(24, 26) quantities(q)
                 left join lineitem_h on year(l_shipdate) = y
                   and l_discount * 100 between d - 1 and d + 1 and l_quantity < q
            group by y, d, q""", "lineitem_h"),
        "sweep_q14": with_views(f"""
            select cast(i + 1 as int) as set_id, cast(m as date) as month,
                   round(cast(sum(case when p_type like 'PROMO%' then {REV} else 0 end) as double)
                         * 100 / cast(sum({REV}) as double), 6) as promo_revenue
            from (select i, cast(date '1993-01-01' + to_months(cast(i as int)) as date) as m
                  from range(0, 60) months(i))
                 left join (lineitem_h join part_h on l_partkey = p_partkey)
                   on l_shipdate >= m and l_shipdate < m + interval 1 month
            group by i, m""", "lineitem_h", "part_h"),
    }
