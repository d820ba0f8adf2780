"""Aggregates, pivots, best rows, neighbours, top lists and spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators import aggregate, ordered, series
from workload.registry import Tables, query


@query("""
    select l_returnflag, l_linestatus, count(*) as n_lines, max(l_quantity) as max_quantity
    from lineitem group by 1, 2""")
def group_by_first_n(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return aggregate.group_by_first(lines, 2).agg(F.count(F.lit(1)).alias("n_lines"),
                                                  F.max("l_quantity").alias("max_quantity"))


@query("""
    select l_returnflag, count(*) as n, count(nullif(l_linenumber, 7)) as n_numbers,
           count(distinct l_suppkey) as n_suppliers, sum(cast(l_quantity as bigint))::bigint as quantity,
           min(l_shipdate) as first_day, max(l_extendedprice) as top_price
    from lineitem group by l_returnflag""")
def basic_aggs(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.expr("nullif(l_linenumber, 7)")).alias("n_numbers"),
        F.count_distinct("l_suppkey").alias("n_suppliers"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.min("l_shipdate").alias("first_day"), F.max("l_extendedprice").alias("top_price"))


@query("""
    select l_orderkey, count(*) as n_lines from lineitem group by l_orderkey having count(*) > 6""")
def having_filter(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines")).filter("n_lines > 6")


@query("""
    select value from (
        select nullif(p_brand, 'Brand#4') as value, count(*) as n from part where p_size > 10 group by 1
        order by n desc, value nulls first limit 7)""")
def column_values_by_count(t: Tables) -> DataFrame:
    parts = t.part.withColumn("brand", F.expr("nullif(p_brand, 'Brand#4')"))
    return aggregate.column_values(parts, "brand", where="p_size > 10", max_records=7)


@query("""
    select user_id, sum(case when event_type = 'click' then 1 else 0 end)::bigint as n_click,
           sum(case when event_type = 'error' then 1 else 0 end)::bigint as n_error,
           sum(case when event_type = 'purchase' then 1 else 0 end)::bigint as n_purchase,
           sum(case when event_type = 'signup' then 1 else 0 end)::bigint as n_signup,
           sum(case when event_type = 'view' then 1 else 0 end)::bigint as n_view
    from events group by user_id""")
def pivot_with_else(t: Tables) -> DataFrame:
    """The pivoted values are read from the data."""
    kinds = aggregate.value_list(t.events, "event_type")
    return aggregate.pivot(t.events, ["user_id"], "event_type", sorted(kinds), prefix="n_")


@query("""
    select l_returnflag, max(case when l_quantity >= 10 then l_linenumber else 0 end) as from_10,
           max(case when l_quantity >= 50 then l_linenumber else 0 end) as from_50,
           count(distinct case when l_quantity < 25 then l_suppkey end) as suppliers_below_25
    from lineitem group by l_returnflag""")
def pivot_compare(t: Tables) -> DataFrame:
    """Another comparison, another aggregate, a column as value."""
    steps = aggregate.pivot_columns("l_quantity", [10, 50], agg="max", cmp=">=", prefix="from_", then_value=F.col("l_linenumber"))
    below = aggregate.pivot_columns("l_quantity", [25], agg="count", cmp="<", prefix="suppliers below ", distinct=True,
                                    then_value=F.col("l_suppkey"), else_value=None, quote_identifiers=False)
    return t.lineitem.groupBy("l_returnflag").agg(*steps, *below)


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate from (
        select *, row_number() over (partition by l_orderkey, l_linenumber
                 order by l_shipdate desc nulls last, l_extendedprice, l_partkey, l_suppkey, l_quantity) as rn
        from lineitem) where rn = 1""")
def dedup_best_row(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                              "l_shipdate")
    return aggregate.best_row(lines, ["l_orderkey", "l_linenumber"], [
        F.desc_nulls_last("l_shipdate"), F.asc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_suppkey"),
        F.asc("l_quantity")])


@query("""
    select event_type, event_id, ts, value from (
        select *, row_number() over (partition by event_type order by value desc, event_id) as rn from events)
    where rn = 1""")
def best_row_few_keys(t: Tables) -> DataFrame:
    """Five keys hold all rows: each task keeps one row per key before the shuffle."""
    events = t.events.select("event_type", "event_id", "ts", "value")
    return aggregate.best_row(events, ["event_type"], [F.desc("value"), F.asc("event_id")])


@query("""
    select p_partkey, p_name, 'p_brand' as prop, nullif(p_brand, 'Brand#4') as val from part
    union all select p_partkey, p_name, 'p_size', cast(p_size as varchar) from part
    union all select p_partkey, p_name, 'is_large', case when p_size > 25 then 'true' else 'false' end from part""")
def unpivot_mixed_types(t: Tables) -> DataFrame:
    parts = t.part.selectExpr("p_partkey", "p_name", "nullif(p_brand, 'Brand#4') as p_brand", "p_type", "p_size",
                              "p_size > 25 as is_large")
    return aggregate.unpivot(parts, exclude=["P_PARTKEY", "p_name"], remove=["P_Type"], field_name="prop",
                             value_name="val")


@query("""
    select event_id, user_id, ts, lag(event_id) over w as previous_event,
           cast(epoch_us(ts) - epoch_us(lag(ts) over w) as bigint) as gap_us
    from events window w as (partition by user_id order by ts, event_id)""")
def lag_gap(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts")
    rows = ordered.with_previous(events, ["event_id", "ts"], ["ts", "event_id"], ["user_id"])
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("previous.ts").cast("timestamp"))
    return rows.select("event_id", "user_id", "ts", F.col("previous.event_id").alias("previous_event"),
                       micros.alias("gap_us"))


@query("""
    select event_id, lead(event_id) over (order by ts, event_id) as next_event,
           lead(user_id) over (order by ts, event_id) as next_user
    from events""")
def lead_next(t: Tables) -> DataFrame:
    """Over the whole table, without groups."""
    rows = ordered.with_next(t.events.select("event_id", "user_id", "ts"), ["event_id", "user_id"], ["ts", "event_id"])
    return rows.select("event_id", F.col("next.event_id").alias("next_event"), F.col("next.user_id").alias("next_user"))


@query("""
    select o_orderkey, o_orderstatus,
           row_number() over (partition by o_orderstatus order by o_orderdate desc, o_orderkey desc) = 1 as is_last
    from orders""")
def last_row_flag(t: Tables) -> DataFrame:
    """Three statuses hold all rows."""
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    rows = ordered.with_next(orders, ["o_orderkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"])
    return rows.select("o_orderkey", "o_orderstatus", F.col("next").isNull().alias("is_last"))


@query("""
    select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25""")
def top_k(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("""
    select exists (select 1 from orders where o_totalprice > 499000) as any_big,
           exists (select 1 from orders where o_totalprice < 0) as any_negative, count(*) as n_orders
    from orders""")
def exists_probe(t: Tables) -> DataFrame:
    def some(condition: str):
        return t.orders.filter(condition).limit(1).agg(F.count(F.lit(1)) > 0).scalar()

    return t.orders.agg(some("o_totalprice > 499000").alias("any_big"), some("o_totalprice < 0").alias("any_negative"),
                        F.count(F.lit(1)).alias("n_orders"))


@query("""
    select cast(d as date) as date_day, count(event_id) as n_events
    from (select unnest(generate_series(min(cast(ts as date)) - 2, max(cast(ts as date)) + 2, interval 1 day)) as d
          from events)
    left join events on cast(ts as date) = cast(d as date) group by 1""")
def date_spine_daily_counts(t: Tables) -> DataFrame:
    """Events per day on a spine that reaches two days beyond them on both sides; days without events count 0."""
    daily = t.events.groupBy(F.to_date("ts").alias("date_day")).agg(F.count(F.lit(1)).alias("n_events"))
    ends = daily.agg(F.min("date_day").alias("first"), F.max("date_day").alias("last")).first()
    spine = series.date_spine(t.spark, "day", ends["first"] - dt.timedelta(2), ends["last"] + dt.timedelta(3))
    return spine.join(daily, "date_day", "left").select("date_day", F.coalesce("n_events", F.lit(0)).alias("n_events"))


@query("""
    select cast(d as date) as date_month, count(o_orderkey) as n_orders
    from (select unnest(generate_series(timestamp '1994-10-01', timestamp '2002-01-01', interval 1 month)) as d)
    left join orders on date_trunc('month', o_orderdate) = d where d < timestamp '2002-01-01' group by 1""")
def month_spine_counts(t: Tables) -> DataFrame:
    month = F.date_trunc("month", "o_orderdate").cast("date")
    monthly = t.orders.groupBy(month.alias("date_month")).agg(F.count(F.lit(1)).alias("n_orders"))
    spine = series.date_spine(t.spark, "month", dt.date(1994, 10, 1), dt.date(2002, 1, 1))
    return spine.join(monthly, "date_month", "left").select("date_month", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query("""
    select cast(g as bigint) as generated_number, count(p_partkey) as n_parts
    from (select unnest(generate_series(1, (select max(p_size) + 3 from part))) as g) left join part on p_size = g
    group by 1""")
def number_series(t: Tables) -> DataFrame:
    """Parts of every size from 1 to beyond the largest one."""
    sizes = t.part.groupBy("p_size").agg(F.count(F.lit(1)).alias("n_parts"))
    largest = sizes.agg(F.max("p_size")).first()[0]
    numbers = series.number_series(t.spark, largest + 3)
    return (numbers.join(sizes, F.col("generated_number") == F.col("p_size"), "left")
            .select("generated_number", F.coalesce("n_parts", F.lit(0)).alias("n_parts")))
