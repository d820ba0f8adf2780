"""Sources, sinks and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators import load
from harborline.operators.setops import union_relations
from harborline.session import staging_path
from harborline.sources.files import read_csv_seed, read_json_lines
from harborline.sources.tables import catalog_tables, catalog_tables_by_prefix, stored_tables
from workload.registry import Tables, query


@query("""
    select o_orderkey as invoice_number, o_custkey as account_number, o_totalprice as amount,
           o_orderdate as created_at
    from orders""")
def scan_rename(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("invoice_number"), F.col("o_custkey").alias("account_number"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("created_at"))


@query("""
    select event_id,
           case when event_type in ('error', 'signup') then null else event_type end as event_type,
           case when event_type in ('error', 'signup') then null else user_id end as user_id,
           case when event_type = 'error' then 'malformed'
                when event_type = 'signup' and value < 20 then 'missing: user_id'
                when event_type = 'signup' then 'null: event_type' end as reason
    from events""")
def jsonl_import_rejects(t: Tables) -> DataFrame:
    """Events written as JSON lines: 'error' ones cut short, 'signup' ones without a key or a value."""
    whole = F.to_json(F.struct("event_id", "event_type", "user_id"))
    no_user = F.to_json(F.struct("event_id", "event_type"))
    null_type = F.to_json(F.struct("event_id", F.lit(None).cast("string").alias("event_type"), "user_id"),
                          {"ignoreNullFields": "false"})
    line = (F.when(F.col("event_type") == "error", F.expr("left(line, length(line) - 5)"))
            .when((F.col("event_type") == "signup") & (F.col("value") < 20), no_user)
            .when(F.col("event_type") == "signup", null_type).otherwise(F.col("line")))
    path = staging_path(t.spark, "events-jsonl")
    t.events.withColumn("line", whole).select(line.alias("value")).write.text(path)
    schema = t.events.select("event_id", "event_type", "user_id").schema
    good, rejects = read_json_lines(t.spark, path, schema, schema.names, ["event_type"])
    number = F.regexp_extract("line", '"event_id":([0-9]+)', 1).cast("bigint")
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.select(number.alias("event_id"), "reason"), allowMissingColumns=True)


@query("""
    select c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') as c_mktsegment
    from customer""")
def csv_seed_typed(t: Tables) -> DataFrame:
    seed = t.customer.withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')"))
    path = staging_path(t.spark, "customer-csv")
    seed.write.option("header", True).csv(path)
    return read_csv_seed(t.spark, path, seed.schema)


@query("""
    select 'customer' as source_relation, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           cast(null as bigint) as s_suppkey, cast(null as varchar) as s_name, cast(null as integer) as s_nationkey,
           cast(null as double) as s_acctbal
    from customer
    union all
    select 'supplier', null, null, null, null, null, s_suppkey, s_name, s_nationkey, s_acctbal from supplier""")
def union_by_name_pattern(t: Tables) -> DataFrame:
    return union_relations(stored_tables(t.spark, t.root, "%ER"))


@query("""
    select 'filed.orders_' || lower(o_orderstatus) as source_relation, o_orderkey, o_totalprice from orders
    where o_orderstatus <> 'P'""")
def union_catalog_tables(t: Tables) -> DataFrame:
    """Orders filed by status as tables of a catalog, found again by prefix and by pattern."""
    t.spark.sql("create database if not exists filed")
    for status in ("F", "O", "P"):
        orders = t.orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_totalprice")
        path = staging_path(t.spark, f"orders-{status}")
        orders.write.mode("overwrite").option("path", path).saveAsTable(f"filed.orders_{status.lower()}")
    found = catalog_tables_by_prefix(t.spark, "filed", "ORDERS_", exclude="%_p")
    assert sorted(found) == sorted(catalog_tables(t.spark, "FILED", "orders__", exclude="%P"))
    return union_relations(found)


@query("""
    select o_orderkey, o_orderpriority, o_totalprice * 2 as o_totalprice from orders""")
def full_refresh_roundtrip(t: Tables) -> DataFrame:
    """Two full refreshes, the second one reading the first; then the current version as a view."""
    root = staging_path(t.spark, "orders-versions")
    load.write_version(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), root)
    current = load.read_current(t.spark, root)
    load.write_version(current.withColumn("o_totalprice", F.col("o_totalprice") * 2), root)
    load.as_view(load.read_current(t.spark, root), "orders_current")
    return t.spark.table("orders_current")


@query("""
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders
    where o_orderdate < timestamp '1998-01-01'
    union all
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority from orders
    where o_orderdate >= timestamp '1998-01-01'""")
def merge_by_key(t: Tables) -> DataFrame:
    """Orders up to 1998, merged with repriced ones from 1998 on: 1998 is replaced, the rest added."""
    target = t.orders.filter("o_orderdate < timestamp_ntz '1999-01-01'")
    source = (t.orders.filter("o_orderdate >= timestamp_ntz '1998-01-01'")
              .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return load.merge_by_key(target, source, ["o_orderkey"])


@query("""
    select o_orderkey, year(o_orderdate)::int as order_year, o_orderstatus,
           case when year(o_orderdate) in (1997, 1998) then o_totalprice + 1 else o_totalprice end as o_totalprice
    from orders""")
def merge_touched_partitions(t: Tables) -> DataFrame:
    """Orders by year without the open ones of 1998, merged with 1997 and 1998 (repriced, some new); other years stay."""
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"), "o_orderstatus", "o_totalprice")
    path = staging_path(t.spark, "orders-by-year")
    orders.filter("order_year <> 1998 or o_orderstatus <> 'O'").write.partitionBy("order_year").parquet(path)
    source = (orders.filter("order_year in (1997, 1998)")
              .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return load.merge_touched_partitions(t.spark, path, source, ["order_year", "o_orderkey"], "order_year")


@query("""
    with target as (select * from customer where c_nationkey <= 14),
         source as (select c_custkey, upper(c_name) as c_name, c_nationkey, c_acctbal + 10 as c_acctbal,
                           nullif(c_mktsegment, 'BUILDING') as c_mktsegment
                    from customer where c_nationkey >= 10)
    select coalesce(s.c_custkey, t.c_custkey) as c_custkey,
           case when t.c_custkey is null then s.c_name else t.c_name end as c_name,
           case when s.c_custkey is null then t.c_nationkey else s.c_nationkey end as c_nationkey,
           case when s.c_custkey is null then t.c_acctbal else s.c_acctbal end as c_acctbal,
           case when s.c_custkey is null then t.c_mktsegment else s.c_mktsegment end as c_mktsegment
    from target t full join source s on t.c_custkey = s.c_custkey""")
def upsert_insert_only_columns(t: Tables) -> DataFrame:
    """The name is kept for known customers; a NULL segment in the source overwrites."""
    target = t.customer.filter("c_nationkey <= 14")
    source = t.customer.filter("c_nationkey >= 10").withColumns({
        "c_name": F.upper("c_name"), "c_acctbal": F.col("c_acctbal") + 10,
        "c_mktsegment": F.expr("nullif(c_mktsegment, 'BUILDING')")})
    return load.upsert(target, source, ["c_custkey"], ["c_name"])


@query("""
    select event_id, user_id, event_type, nullif(value, 0.01) as value from events s
    where not exists (select 1 from events t where t.ts < timestamp '2024-01-15' and t.event_id = s.event_id
                      and t.event_type = nullif(s.event_type, 'view'))""")
def append_new_only(t: Tables) -> DataFrame:
    """All events against those loaded before 15 January; a NULL type matches nothing and is always new."""
    loaded = t.events.filter("ts < timestamp_ntz '2024-01-15'").select("event_id", "user_id", "event_type", "value")
    source = t.events.select("event_id", "user_id", "event_type", F.expr("nullif(value, 0.01D)").alias("value"),
                             F.expr("nullif(event_type, 'view')").alias("type_key"))
    return load.new_rows(loaded.withColumn("type_key", F.col("event_type")), source,
                         ["event_id", "type_key"]).drop("type_key")


@query("""
    select event_id, user_id from events where ts >= timestamp '2024-01-15'""")
def append_new_null_safe(t: Tables) -> DataFrame:
    """With NULL equal to NULL only the events not yet loaded are new."""
    keyed = t.events.select("event_id", "user_id", "ts", F.expr("nullif(event_type, 'view')").alias("kind"))
    loaded = keyed.filter("ts < timestamp_ntz '2024-01-15'")
    return load.new_rows(loaded, keyed, ["event_id", "kind"], null_safe=True).select("event_id", "user_id")


@query("""
    select event_id, ts, event_type, value from events where ts >= timestamp '2024-01-15' or event_id % 3 = 0""")
def append_new_pruned(t: Tables) -> DataFrame:
    """A stored target without every third event, appended to with the events it lacks; only their days are scanned."""
    path = staging_path(t.spark, "events-loaded")
    events = t.events.select("event_id", "ts", "event_type", "value")
    events.filter("ts < timestamp_ntz '2024-01-15' and event_id % 3 <> 0").write.parquet(path)
    source = events.filter("ts >= timestamp_ntz '2024-01-10' or event_id % 3 = 0")
    return load.new_rows(t.spark.read.parquet(path), source, ["event_id", "ts"], prune_by="ts")


@query("""
    select o_orderkey, o_orderdate, row_number() over (order by o_orderdate, o_orderkey) as order_id from orders""")
def dense_identity(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return load.add_identity(orders, ["o_orderdate", "o_orderkey"], "order_id", "bigint")


@query("""
    select 2 * count(*) as stored, count(*) as reported from orders""")
def append_count(t: Tables) -> DataFrame:
    """Orders appended twice; the count of the second append comes from the write itself."""
    path = staging_path(t.spark, "orders-appended")
    load.append_counted(t.orders, path)
    reported = load.append_counted(t.orders, path)
    return t.spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("stored"), F.lit(reported).cast("bigint").alias("reported"))
