"""Loads into indexed tables, checks of increments, comparison by checksums, one-scan unions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.text import collated
from harborline.operators import bucketed, check_state, indexed
from harborline.operators.aggregate import top_values
from harborline.operators.setops import difference_by_checksum
from harborline.operators.suite import Check
from harborline.session import staging_path
from harborline.sources.tables import like_tables
from harborline.streaming.incremental import stream_append_batches
from workload.jobs import packages_job
from workload.registry import ENTRIES, Tables, query


@query("""
    select o_orderkey, o_custkey, case when o_orderkey between 1000 and 1100 then -o_totalprice else o_totalprice end as o_totalprice
    from orders
    union all
    select -o_orderkey - 1, o_custkey, o_totalprice from orders where o_orderkey between 1000 and 1100""")
def indexed_merge(t: Tables) -> DataFrame:
    """A merge that touches one stretch of the keys, and adds keys below all others."""
    path = staging_path(t.spark, "orders-indexed")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    indexed.create(orders, path, ["o_orderkey"], rows_per_file=5000)
    some = orders.filter("o_orderkey between 1000 and 1100")
    source = some.withColumn("o_totalprice", -F.col("o_totalprice")).union(some.withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    return indexed.merge(t.spark, path, source, batch="changes", rows_per_file=5000)


@query("""
    select case when c_nationkey = 3 then null else c_custkey end as c_custkey, c_name,
           row_number() over (order by c_custkey % 3, c_name) as row_id
    from customer""")
def indexed_append_batches(t: Tables) -> DataFrame:
    """Three batches, the second one loaded twice; keys that are NULL; numbers that go on from load to load."""
    path = staging_path(t.spark, "customers-indexed")
    rows = t.customer.select(F.when(F.col("c_nationkey") != 3, F.col("c_custkey")).alias("c_custkey"), "c_name",
                             (F.col("c_custkey") % 3).alias("batch"))
    empty = rows.drop("batch").withColumn("row_id", F.lit(0).cast("bigint")).limit(0)
    indexed.create(empty, path, ["c_custkey"])
    for batch in (0, 1, 1, 2):
        part = rows.filter(F.col("batch") == batch).drop("batch")
        out = indexed.append(t.spark, path, part, batch=f"batch {batch}", number="row_id", order_by=["c_name"])
    return out


@query("""
    select 'flag known' as "check", count(*) filter (l_returnflag is null) as failures, 'pass' as status from lineitem
    union all select 'quantity', count(*) filter (not l_quantity between 0 and 45), 'error' from lineitem
    union all select 'line once', (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)), 'warn'
    union all select 'order once', (select count(*) from (select 1 from lineitem where l_linenumber = 1 group by l_orderkey having count(*) > 1)), 'error'
    union all select 'status varies', case when min(l_linestatus) = max(l_linestatus) then 1 else 0 end, 'pass' from lineitem
    union all select 'half small', case when count(case when l_quantity < 26 then 1 end) / count(*) between 0.4 and 0.6 then 0 else 1 end, 'pass'
              from lineitem""")
def check_state_increments(t: Tables) -> DataFrame:
    """Three increments of the lines, each read once for its state; the states give the result of the whole table."""
    lines = t.lineitem.withColumn("small", F.expr("if(l_quantity < 26, 1, null)"))
    checks = [
        Check("flag known", "lineitem", "not_null", {"column": "l_returnflag"}),
        Check("quantity", "lineitem", "accepted_range", {"column": "l_quantity", "min_value": 0, "max_value": 45}),
        Check("line once", "lineitem", "unique_combination_of_columns", {"columns": ["l_orderkey", "l_linenumber"]}, severity="warn"),
        Check("order once", "lineitem", "unique", {"column": "l_orderkey"}, where="l_linenumber = 1"),
        Check("status varies", "lineitem", "not_constant", {"column": "l_linestatus"}),
        Check("half small", "lineitem", "not_null_proportion", {"column": "small", "at_least": 0.4, "at_most": 0.6}),
    ]
    root = staging_path(t.spark, "lineitem-state")
    for day in range(3):
        check_state.store_state(lines.filter(F.col("l_orderkey") % 3 == day), checks, root, f"day {day}")
    return check_state.checked(t.spark, root, checks)


@query("""
    select case when o_orderstatus <> 'F' then o_orderkey end as o_orderkey, o_custkey,
           case when o_orderstatus <> 'F' and o_orderkey % 50 = 3 then null else o_totalprice end as o_totalprice, o_orderpriority
    from orders
    union all
    select -o_orderkey - 1, o_custkey, null, 'late' from orders where o_orderstatus <> 'F' and o_orderkey % 50 = 3""")
def bucketed_merge(t: Tables) -> DataFrame:
    """Orders in buckets of their key, those without one beside them; a merge that keeps the priority of known orders."""
    name = f"orders_{uuid.uuid4().hex}"
    orders = t.orders.select(F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("o_orderkey"), "o_custkey",
                             "o_totalprice", "o_orderpriority")
    bucketed.create(orders, name, ["o_orderkey", "o_custkey"], 8)
    some = orders.filter(F.col("o_orderkey") % 50 == 3).withColumns({"o_totalprice": F.lit(None), "o_orderpriority": F.lit("late")})
    source = some.union(some.withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    return bucketed.merge(t.spark, name, source, keep=["o_orderpriority"])


@query("""
    select c_custkey, case when c_custkey % 3 = 0 then cast(c_nationkey as bigint) else c_nationkey + 3000000000 end as code,
           cast(c_acctbal as decimal(12,2))::double * case when c_custkey % 3 = 0 then 1 else 0.5 end as balance,
           case when c_custkey % 3 = 2 then c_mktsegment end as segment
    from customer""")
def schema_drift_versions(t: Tables) -> DataFrame:
    """Three loads: the second has wider types, the third a column more; the files of the first stay as they are."""
    path, key = staging_path(t.spark, "customers-drift"), F.col("c_custkey")
    balance = F.col("c_acctbal").cast("decimal(12,2)")
    first = t.customer.select("c_custkey", "c_nationkey", balance.alias("balance")).withColumnRenamed("c_nationkey", "code")
    wide = t.customer.select("c_custkey", (F.col("c_nationkey") + F.lit(3_000_000_000)).alias("code"),
                             (balance * F.lit(0.5).cast("decimal(2,1)")).cast("decimal(16,4)").alias("balance"),
                             F.col("c_mktsegment").alias("segment"))
    indexed.create(first.filter(key % 3 == 0), path, ["c_custkey"])
    indexed.append(t.spark, path, wide.filter(key % 3 == 1).drop("segment"), batch="wider", on_change="add")
    out = indexed.append(t.spark, path, wide.filter(key % 3 == 2), batch="more", on_change="add")
    return out.withColumn("balance", F.col("balance").cast("double"))


@query("""
    select event_id, case when event_type <> 'error' then user_id end as user_id, row_number() over (order by event_id) as row_id
    from events""")
def stream_append_ledger(t: Tables) -> DataFrame:
    """Events, some without a key, from landing files into an indexed table by a stream, in numbered order."""
    landing, path, checkpoint = (staging_path(t.spark, f"events-{label}") for label in ("landing", "indexed", "checkpoint"))
    rows = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    rows.write.parquet(landing)
    indexed.create(rows.withColumn("row_id", F.lit(0).cast("bigint")).limit(0), path, ["event_id", "user_id"])
    for _ in range(2):  # the second run finds no new file
        stream_append_batches(t.spark, landing, rows.schema, path, checkpoint, number="row_id", order_by=["event_id"]).awaitTermination()
    return indexed.read(t.spark, path)


_CHANGED = """
    select o_orderkey, case when o_orderkey % 983 = 5 then null else o_custkey end as o_custkey,
           case when o_orderkey % 991 = 7 then o_totalprice + 1 else o_totalprice end as o_totalprice
    from {orders} where o_orderkey % 997 <> 3
    union all select o_orderkey, o_custkey, o_totalprice from {orders} where o_orderkey % 500 = 11"""


@query(f"""
    with a as (select o_orderkey, o_custkey, o_totalprice from orders), b as ({_CHANGED.format(orders="orders")})
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
    union all select 'b_minus_a', * from (select * from b except select * from a)""")
def checksum_difference(t: Tables) -> DataFrame:
    """Orders against a copy with rows lost, changed, turned NULL and repeated."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    key = F.col("o_orderkey")
    changed = orders.filter(key % 997 != 3).select(
        "o_orderkey", F.when(key % 983 != 5, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 991 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    changed = reduce(DataFrame.union, [changed, orders.filter(key % 500 == 11)])
    return difference_by_checksum(orders, changed)


@query("""
    select 'late_' || (l_orderkey % 4) as source_relation, l_orderkey, l_quantity,
           case when l_orderkey % 4 = 3 then l_tax end as l_tax
    from lineitem where l_orderkey % 4 <> 0""")
def like_tables_one_scan(t: Tables) -> DataFrame:
    """Four stored tables, one left out by its name, one with a column more: two scans."""
    root = staging_path(t.spark, "like-tables")
    for part in range(4):
        names = ["l_orderkey", "l_quantity", *(["l_tax"] if part == 3 else [])]
        rows = t.lineitem.filter(F.col("l_orderkey") % 4 == part).select(*names)
        rows.write.parquet(f"{root}/{'early' if part == 0 else 'late'}_{part}.parquet")
    return like_tables(t.spark, root, "LATE%")


@query("""
    select lower(rtrim(o.o_orderpriority)) as priority, count(*) as n_orders, sum(p.rank)::bigint as ranks
    from orders o join (select o_orderpriority, row_number() over (order by o_orderpriority) as rank
                        from (select distinct o_orderpriority from orders)) p on lower(rtrim(o.o_orderpriority)) = lower(rtrim(p.o_orderpriority))
    group by 1""")
def collated_keys(t: Tables) -> DataFrame:
    """A join and a grouping on collated text: spellings differ in case and trailing blanks on both sides."""
    spelled = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lower("o_orderpriority"), F.lit("  "))).when(
        F.col("o_orderkey") % 3 == 1, F.upper("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    orders = t.orders.select(collated(spelled).alias("priority"))
    names = t.orders.select("o_orderpriority").distinct().withColumn("rank", F.rank().over(Window.orderBy("o_orderpriority")))
    names = names.select(collated(F.upper("o_orderpriority")).alias("name"), "rank")
    joined = orders.join(names, F.col("priority") == F.col("name")).groupBy("priority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("rank").cast("bigint").alias("ranks"))
    return joined.withColumn("priority", F.lower(F.rtrim(F.col("priority").cast("string"))))


@query("""
    select l_extendedprice as value, count(*) as n from lineitem group by 1 order by n desc, value limit 25""")
def top_values_wide(t: Tables) -> DataFrame:
    """The most frequent prices, of nearly as many prices as lines."""
    return top_values(t.lineitem, "l_extendedprice", 25, cells=4096)


@query(ENTRIES["job_packages"].sql)
def job_packages_stored_key(t: Tables) -> DataFrame:
    """As ``job_packages``, the target keeping the key of its packages, so that a range of it is read."""
    return packages_job(t, stored_key="PackageKey")
