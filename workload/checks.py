"""Every data-quality check on data that breaks it in places, and the suite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators import checks
from harborline.operators.suite import Check, run_suite, store_failures
from harborline.session import staging_path
from workload.registry import Tables, query


@query("select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority from orders where o_orderpriority = '5-LOW'")
def check_not_null(t: Tables) -> DataFrame:
    orders = t.orders.selectExpr("o_orderkey", "nullif(o_orderpriority, '5-LOW') as priority")
    return checks.not_null(orders, "priority")


@query("""
    select account, count(*) as n_records from (select nullif(o_custkey, 3) as account from orders)
    where account is not null group by account having count(*) > 1""")
def check_unique(t: Tables) -> DataFrame:
    return checks.unique(t.orders.selectExpr("nullif(o_custkey, 3L) as account"), "account")


@query("""
    select nullif(user_id, 7) as id from events
    where nullif(user_id, 7) is not null and user_id not in (select s_suppkey from supplier)""")
def check_relationships(t: Tables) -> DataFrame:
    events = t.events.selectExpr("nullif(user_id, 7L) as user_id")
    return checks.relationships(events, "user_id", t.supplier, "s_suppkey")


@query("""
    select kind as value_field, count(*) as n_records from (select nullif(event_type, 'view') as kind from events)
    where kind not in ('click', 'purchase') group by kind""")
def check_accepted_values(t: Tables) -> DataFrame:
    events = t.events.selectExpr("nullif(event_type, 'view') as kind")
    return checks.accepted_values(events, "kind", ["click", "purchase"])


@query("""
    select distinct l_orderkey, l_linenumber from (select nullif(l_orderkey, 1) as l_orderkey, l_linenumber from lineitem) a
    where l_orderkey is not null and not exists (
        select 1 from lineitem b where b.l_returnflag <> 'A' and b.l_orderkey = a.l_orderkey
        and b.l_linenumber = a.l_linenumber)""")
def check_multi_column_relationship(t: Tables) -> DataFrame:
    lines = t.lineitem.selectExpr("nullif(l_orderkey, 1L) as l_orderkey", "l_linenumber")
    known = t.lineitem.filter("l_returnflag <> 'A'").selectExpr("l_orderkey as k", "l_linenumber as n")
    return checks.multi_column_relationship(lines, known, ["l_orderkey", "l_linenumber"], ["k", "n"])


@query("""
    select event_id, value from events where nullif(value, 100) < 5 or nullif(value, 100) >= 400""")
def check_accepted_range(t: Tables) -> DataFrame:
    """The lower bound is inclusive in one check, the upper one exclusive in another."""
    events = t.events.selectExpr("event_id", "nullif(value, 100D) as value")
    low = checks.accepted_range(events, "value", min_value=5)
    return low.unionByName(checks.accepted_range(events, "value", max_value=400, inclusive=False))


@query("""
    select l_orderkey, count(flag) as n_values from (select l_orderkey, nullif(l_returnflag, 'A') as flag from lineitem)
    group by l_orderkey having count(flag) = 0""")
def check_at_least_one(t: Tables) -> DataFrame:
    lines = t.lineitem.selectExpr("l_orderkey", "nullif(l_returnflag, 'A') as flag")
    return checks.at_least_one(lines, "flag", ["l_orderkey"])


@query("select count(nullif(o_orderkey, o_orderkey)) as n_values from orders")
def check_at_least_one_ungrouped(t: Tables) -> DataFrame:
    return checks.at_least_one(t.orders.selectExpr("nullif(o_orderkey, o_orderkey) as nothing"), "nothing")


@query("""
    with a as (select p_brand, count(*) as num_rows from part group by 1),
         b as (select p_brand, count(*) as num_rows from part where p_size <> 17 group by 1)
    select * from (select * from a except select * from b)
    union all select * from (select * from b except select * from a)""")
def check_cardinality_equality(t: Tables) -> DataFrame:
    return checks.cardinality_equality(t.part, "p_brand", t.part.filter("p_size <> 17"), "p_brand")


@query("""
    with a as (select o_orderstatus, count(*) as count_a from orders where o_orderpriority < '3' group by 1),
         b as (select o_orderstatus, count(*) as count_b from orders where o_orderstatus <> 'P' group by 1)
    select a.o_orderstatus as o_orderstatus_a, b.o_orderstatus as o_orderstatus_b, count_a, count_b,
           abs(count_a - count_b) as diff_count
    from a full join b on a.o_orderstatus = b.o_orderstatus""")
def check_equal_rowcount(t: Tables) -> DataFrame:
    return checks.equal_rowcount(t.orders.filter("o_orderpriority < '3'"), t.orders.filter("o_orderstatus <> 'P'"),
                                 ["o_orderstatus"])


@query("""
    with a as (select o_orderstatus, count(*) as count_a from orders where o_orderpriority < '3' group by 1),
         b as (select o_orderstatus, count(*) as count_b from orders where o_orderstatus <> 'P' group by 1)
    select a.o_orderstatus as o_orderstatus_a, b.o_orderstatus as o_orderstatus_b, count_a, count_b,
           abs(coalesce(count_a, 0) - coalesce(count_b, 0)) as diff_count
    from a full join b on a.o_orderstatus = b.o_orderstatus""")
def check_equal_rowcount_strict(t: Tables) -> DataFrame:
    return checks.equal_rowcount(t.orders.filter("o_orderpriority < '3'"), t.orders.filter("o_orderstatus <> 'P'"),
                                 ["o_orderstatus"], strict=True)


@query("""
    with a as (select p_partkey, p_brand, round(p_retailprice::decimal(38,18), 1)::double as price from part),
         b as (select p_partkey, p_brand, round((p_retailprice
                 + case when p_size = 9 then 0.3 else 0.0000001 end)::decimal(38,18), 1)::double as price from part)
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
    union all select 'b_minus_a', * from (select * from b except select * from a)""")
def check_equality(t: Tables) -> DataFrame:
    """Prices rounded to one digit: tiny differences pass, larger ones fail."""
    a = t.part.selectExpr("p_partkey", "p_brand", "p_retailprice as price", "p_size")
    b = t.part.selectExpr("p_partkey", "p_brand",
                          "p_retailprice + case when p_size = 9 then 0.3D else 0.0000001D end as price", "p_name as other")
    failing = checks.equality(a, b, compare_columns=["p_partkey", "p_brand", "price"], precision=1)
    return failing.withColumn("price", F.col("price").cast("double"))


@query("""
    select l_orderkey, l_linenumber, l_quantity from lineitem where not (nullif(l_quantity, 50) < 49)""")
def check_expression_is_true(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return checks.expression_is_true(lines, "nullif(l_quantity, 50D) < 49")


@query("""
    with a as (select l_returnflag, count(*) as count_our_model from lineitem where l_linenumber < 5 group by 1),
         b as (select l_returnflag, count(*) as count_comparison_model from lineitem where l_quantity < 25 group by 1)
    select a.l_returnflag as l_returnflag_a, b.l_returnflag as l_returnflag_b, count_our_model, count_comparison_model,
           case when count_our_model > count_comparison_model then count_our_model - count_comparison_model
                when count_our_model = count_comparison_model then 1 else 0 end as row_count_delta
    from a full join b on a.l_returnflag = b.l_returnflag""")
def check_fewer_rows_than(t: Tables) -> DataFrame:
    return checks.fewer_rows_than(t.lineitem.filter("l_linenumber < 5"), t.lineitem.filter("l_quantity < 25"),
                                  ["l_returnflag"])


@query("""
    select count_our_model, count_comparison_model, 1::bigint as row_count_delta
    from (select count(*) as count_our_model from orders), (select count(*) as count_comparison_model from orders)""")
def check_fewer_rows_than_ungrouped(t: Tables) -> DataFrame:
    """Equal counts fail with 1."""
    return checks.fewer_rows_than(t.orders, t.orders)


@query("""
    with r as (
        select user_id as partition_by_col, lower_bound, upper_bound,
               lead(lower_bound) over w as next_lower_bound, lead(1) over w is null as is_last_record
        from (select user_id, cast(ts as date) as lower_bound,
                     cast(ts + interval 1 day * (length(event_type) - 5) as date) as upper_bound from events)
        window w as (partition by user_id order by lower_bound, upper_bound)),
    j as (select *, coalesce(lower_bound <= upper_bound, false) as range_is_proper,
                 coalesce(upper_bound <= next_lower_bound, is_last_record, false) as next_range_is_clear from r)
    select * from j where not (range_is_proper and next_range_is_clear)""")
def check_mutually_exclusive_ranges(t: Tables) -> DataFrame:
    """Event days as validity ranges per user: many start together, overlap or are empty.

    Of equal ranges any one is the last record; the SQL takes both columns from one window for that.
    """
    return checks.mutually_exclusive_ranges(
        t.events, "cast(ts as date)", "date_add(cast(ts as date), length(event_type) - 5)", "user_id", "allowed",
        zero_length_range_allowed=True)


@query("""
    with r as (
        select lower_bound, upper_bound,
               lead(lower_bound) over (order by lower_bound, upper_bound) as next_lower_bound,
               row_number() over (order by lower_bound desc, upper_bound desc) = 1 as is_last_record
        from (select o_orderkey as lower_bound,
                     o_orderkey + case when o_orderstatus = 'F' then 1 when o_orderstatus = 'O' then 2 else 0 end as upper_bound
              from orders)),
    j as (select *, coalesce(lower_bound < upper_bound, false) as range_is_proper,
                 coalesce(upper_bound = next_lower_bound, is_last_record, false) as next_range_is_clear from r)
    select * from j where not (range_is_proper and next_range_is_clear)""")
def check_mutually_exclusive_ranges_no_gaps(t: Tables) -> DataFrame:
    """One sequence over the whole table, gaps not allowed."""
    width = "case when o_orderstatus = 'F' then 1 when o_orderstatus = 'O' then 2 else 0 end"
    return checks.mutually_exclusive_ranges(t.orders, "o_orderkey", f"o_orderkey + {width}", gaps="not_allowed")


@query("""
    with r as (
        select grp as partition_by_col, lower_bound, upper_bound,
               lead(lower_bound) over w as next_lower_bound, lead(1) over w is null as is_last_record
        from (select o_custkey as grp, o_orderkey as lower_bound,
                     o_orderkey + case when o_orderstatus = 'F' then 1 when o_orderstatus = 'O' then 4000 else 0 end as upper_bound
              from orders) window w as (partition by grp order by lower_bound, upper_bound)),
    j as (select *, coalesce(lower_bound < upper_bound, false) as range_is_proper,
                 coalesce(upper_bound < next_lower_bound, is_last_record, false) as next_range_is_clear from r)
    select * from j where not (range_is_proper and next_range_is_clear)""")
def check_mutually_exclusive_ranges_gaps_required(t: Tables) -> DataFrame:
    """One sequence per customer; ranges may not even touch."""
    width = "case when o_orderstatus = 'F' then 1 when o_orderstatus = 'O' then 4000 else 0 end"
    return checks.mutually_exclusive_ranges(t.orders, "o_orderkey", f"o_orderkey + {width}", "o_custkey", gaps="required")


@query("select distinct event_type as value_field from events where event_type in ('error', 'signup', 'refund')")
def check_not_accepted_values(t: Tables) -> DataFrame:
    return checks.not_accepted_values(t.events, "event_type", ["error", "signup", "refund"])


@query("""
    select l_orderkey, count(distinct flag) as n_distinct
    from (select l_orderkey, nullif(l_returnflag, 'N') as flag from lineitem)
    group by l_orderkey having count(distinct flag) = 1""")
def check_not_constant(t: Tables) -> DataFrame:
    lines = t.lineitem.selectExpr("l_orderkey", "nullif(l_returnflag, 'N') as flag")
    return checks.not_constant(lines, "flag", ["l_orderkey"])


@query("select p_partkey, repeat(' ', p_size - 40) as name from part where p_size >= 40")
def check_not_empty_string(t: Tables) -> DataFrame:
    parts = t.part.selectExpr("p_partkey", "case when p_size >= 40 then repeat(' ', p_size - 40) else p_name end as name")
    return checks.not_empty_string(parts, "name")


@query("""
    select user_id, not_null_proportion from (
        select user_id, count(nullif(event_type, 'view')) / count(*) as not_null_proportion from events group by user_id)
    where not_null_proportion < 0.75 or not_null_proportion > 0.9""")
def check_not_null_proportion(t: Tables) -> DataFrame:
    events = t.events.selectExpr("user_id", "nullif(event_type, 'view') as kind")
    return checks.not_null_proportion(events, "kind", 0.75, 0.9, ["user_id"])


@query("""
    select user_id, max(ts) as most_recent, timestamp '2024-01-30 18:00:00' as threshold from events
    group by user_id having max(ts) < timestamp '2024-01-30 18:00:00'""")
def check_recency(t: Tables) -> DataFrame:
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return checks.recency(t.events, "ts", "hour", 6, now, group_by=["user_id"])


@query("""
    select event_type, cast(max(ts) as date) as most_recent, date '2024-01-31' as threshold from events
    group by event_type""")
def check_recency_by_date(t: Tables) -> DataFrame:
    now = F.lit("2024-02-01 23:00:00").cast("timestamp_ntz")
    return checks.recency(t.events, "ts", "day", 1, now, ignore_time_component=True, group_by=["event_type"])


@query("""
    select o_custkey as id from orders where o_orderstatus <> 'F'
      and o_custkey not in (select c_custkey from customer where c_acctbal > 0)""")
def check_relationships_where(t: Tables) -> DataFrame:
    return checks.relationships_where(t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus <> 'F'",
                                      "c_acctbal > 0")


@query("""
    select o_orderstatus, o_orderkey, previous_o_orderkey from (
        select o_orderstatus, o_orderkey,
               lag(o_orderkey) over (partition by o_orderstatus order by o_orderkey) as previous_o_orderkey from orders)
    where o_orderkey <> previous_o_orderkey + 2""")
def check_sequential_values(t: Tables) -> DataFrame:
    return checks.sequential_values(t.orders, "o_orderkey", 2, group_by=["o_orderstatus"])


@query("""
    select day, previous_day from (select cast(o_orderdate as date) as day,
               lag(cast(o_orderdate as date)) over (order by o_orderdate) as previous_day from orders)
    where day <> previous_day + 1""")
def check_sequential_dates(t: Tables) -> DataFrame:
    """Order days must step by one; equal days fail, over the whole table."""
    days = t.orders.selectExpr("cast(o_orderdate as date) as day")
    return checks.sequential_values(days, "day", 1, "day")


@query("""
    select l_orderkey, flag, count(*) as n_records
    from (select l_orderkey, nullif(l_returnflag, 'N') as flag from lineitem)
    group by 1, 2 having count(*) > 1""")
def check_unique_combination(t: Tables) -> DataFrame:
    lines = t.lineitem.selectExpr("l_orderkey", "nullif(l_returnflag, 'N') as flag")
    return checks.unique_combination_of_columns(lines, ["l_orderkey", "flag"])


@query("""
    select column_name, side, n_values from (
        select 'O_CLERK' as column_name, 'b' as side, null::bigint as n_values
        union all select 'O_ORDERDATE', 'a', count(o_orderdate) from orders
        union all select 'O_ORDERPRIORITY', 'a', count(nullif(o_orderpriority, '5-LOW')) from orders)""")
def check_columns_match_set(t: Tables) -> DataFrame:
    """Column names that the table or the list has alone, and how many values the table holds in each of its own."""
    listed = ["O_ORDERKEY", "o_custkey", "o_orderstatus", "o_totalprice", "o_clerk"]
    orders = t.orders.withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')"))
    found = checks.columns_match_set(orders, listed)
    filled = orders.agg(*[F.count(c).alias(c.upper()) for c in orders.columns])
    filled = filled.unpivot([], filled.columns, "name", "n_values")
    return found.join(filled, F.col("column_name") == F.col("name"), "left").select("column_name", "side", "n_values")


@query("""
    select event_id, event_type, kind from (select event_id, event_type,
           case when value > 100 then 'view' when value > 10 then event_type end as kind from events)
    where event_type <> kind""")
def check_assert_equal(t: Tables) -> DataFrame:
    events = t.events.selectExpr("event_id", "event_type",
                                 "case when value > 100 then 'view' when value > 10 then event_type end as kind")
    return checks.assert_equal(events, "event_type", "kind")


@query("""
    select event_id, value from events where event_type = 'error' and value < 1""")
def check_with_where(t: Tables) -> DataFrame:
    errors = t.events.filter("event_type = 'error'").select("event_id", "value")
    return checks.accepted_range(errors, "value", min_value=1)


def suite_checks() -> list[Check]:
    return [
        Check("order_key_not_null", "orders", "not_null", {"column": "o_orderkey"}),
        Check("order_key_unique", "orders", "unique", {"column": "o_orderkey"}),
        Check("order_price_range", "orders", "accepted_range", {"column": "o_totalprice", "min_value": 5000, "max_value": 490000},
              severity="warn"),
        Check("order_old_price_range", "orders", "accepted_range", {"column": "o_totalprice", "max_value": 400000},
              where="o_orderdate < timestamp_ntz '1996-01-01'"),
        Check("order_status_known", "orders", "accepted_values", {"column": "o_orderstatus", "values": ["F", "O"]}),
        Check("order_customer_known", "orders", "relationships", {"column": "o_custkey", "to": "customer", "field": "c_custkey"}),
        Check("order_status_not_constant", "orders", "not_constant", {"column": "o_orderstatus"}),
        Check("line_quantity_whole", "lineitem", "expression_is_true", {"expression": "l_quantity = floor(l_quantity)"}),
        Check("line_discount_small", "lineitem", "expression_is_true", {"expression": "< 0.1", "column": "l_discount"},
              error_if="> 1000000000"),
        Check("line_flag_present", "lineitem", "at_least_one", {"column": "l_returnflag"}),
        Check("line_unique", "lineitem", "unique_combination_of_columns",
              {"columns": ["l_orderkey", "l_linenumber"]}),
        Check("line_orders_match", "lineitem", "equal_rowcount", {"compare": "orders"}),
        Check("line_fewer_than_orders", "lineitem", "fewer_rows_than", {"compare": "orders"}),
        Check("line_tax_given", "lineitem", "not_null_proportion", {"column": "l_tax", "at_least": 0.99}),
        Check("line_recent", "lineitem", "recency", {"field": "l_shipdate", "part": "day", "interval": 30,
                                                     "now": F.lit("1999-07-01 00:00:00").cast("timestamp_ntz")}),
        Check("line_flag_text", "lineitem", "not_empty_string", {"column": "l_returnflag"}, error_if="> 1000000000"),
    ]


SUITE_SQL = """
    with line as (select count(*) as n, count(*) filter (not l_quantity = floor(l_quantity)) as odd,
                         count(*) filter (not l_discount < 0.1) as steep, count(l_returnflag) as flags,
                         count(*) filter (trim(l_returnflag) = '') as blank, count(l_tax)::double / count(*) as taxed,
                         max(l_shipdate) as shipped from lineitem),
         ord as (select count(*) as n, count(*) filter (o_orderkey is null) as no_key,
                        count(*) filter (o_totalprice < 5000 or o_totalprice > 490000) as outside,
                        count(*) filter (o_totalprice > 400000 and o_orderdate < timestamp '1996-01-01') as old,
                        count(distinct o_orderstatus) as kinds from orders),
         found as (
        select 'order_key_not_null' as "check", no_key as failures, 'error' as worst from ord
        union all select 'order_key_unique', count(*), 'error'
                  from (select 1 from orders group by o_orderkey having count(*) > 1)
        union all select 'order_price_range', outside, 'warn' from ord
        union all select 'order_old_price_range', old, 'error' from ord
        union all select 'order_status_known', count(distinct o_orderstatus), 'error' from orders where o_orderstatus = 'P'
        union all select 'order_customer_known', count(*), 'error' from orders
                  where o_custkey not in (select c_custkey from customer)
        union all select 'order_status_not_constant', (kinds = 1)::int, 'error' from ord
        union all select 'line_quantity_whole', odd, 'error' from line
        union all select 'line_discount_small', steep, 'warn' from line
        union all select 'line_flag_present', (flags = 0)::int, 'error' from line
        union all select 'line_unique', count(*), 'error'
                  from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
        union all select 'line_orders_match', abs(line.n - ord.n), 'error' from line, ord
        union all select 'line_fewer_than_orders', greatest(line.n - ord.n, (line.n = ord.n)::int), 'error' from line, ord
        union all select 'line_tax_given', (taxed < 0.99)::int, 'error' from line
        union all select 'line_recent', (shipped < timestamp '1999-06-01')::int, 'error' from line
        union all select 'line_flag_text', blank, 'warn' from line)
    select "check", failures::bigint as failures, case when failures <> 0 then worst else 'pass' end as status from found"""


@query(SUITE_SQL)
def check_suite(t: Tables) -> DataFrame:
    return run_suite({"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer}, suite_checks())


@query(SUITE_SQL)
def check_suite_stored(t: Tables) -> DataFrame:
    """The same numbers from the stored failing rows, each check evaluated once."""
    root = staging_path(t.spark, "failures")
    return run_suite({"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer}, suite_checks(), store=root)


@query("""
    select o_orderkey, o_totalprice from orders where o_totalprice < 5000 or o_totalprice > 490000""")
def check_store_failures(t: Tables) -> DataFrame:
    """The failing rows themselves, read back from where a check with an awkward name stored them."""
    spec = Check("prices / out of range?", "orders", "accepted_range",
                 {"column": "o_totalprice", "min_value": 5000, "max_value": 490000})
    paths = store_failures({"orders": t.orders}, [spec], staging_path(t.spark, "failures"))
    return t.spark.read.parquet(paths[spec.name]).select("o_orderkey", "o_totalprice")
