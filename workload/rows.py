"""Projections, filters and scalar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions import dates, numbers, text, urls
from harborline.functions.keys import NULL_TOKEN
from harborline.functions.keys import surrogate_key as key_of
from harborline.operators import project
from harborline.plans import lookups as L
from workload.registry import Tables, query


@query("""
    select p_partkey as src_p_partkey_v1, p_name as src_p_name_v1, p_type as src_p_type_v1, p_size as src_p_size_v1
    from part""")
def star_except_prefix(t: Tables) -> DataFrame:
    return t.part.select(project.star(t.part, ["P_BRAND", "p_retailprice"], prefix="src_", suffix="_v1"))


@query("""
    select max(p_brand) as p_brand, max(p_type) as p_type, max(p_size) as p_size from part""")
def max_of_filtered_columns(t: Tables) -> DataFrame:
    names = project.columns_except(t.part, ["p_partkey", "P_NAME", "p_retailprice"])
    return t.part.agg(*[F.max(c).alias(c) for c in names])


@query("""
    select p_partkey, nullif(case when p_size > 40 then '' else p_name end, '') as p_name,
           nullif(case when p_size < 5 then '' when p_size < 10 then ' ' else p_brand end, '') as p_brand, p_size
    from part""")
def empty_to_null(t: Tables) -> DataFrame:
    parts = t.part.selectExpr(
        "p_partkey", "case when p_size > 40 then '' else p_name end as p_name",
        "case when p_size < 5 then '' when p_size < 10 then ' ' else p_brand end as p_brand", "p_size")
    return project.empty_to_null(parts)


@query("""
    select o_orderkey, 12 as user_id, cast(null as varchar) as repository_type, '' as photo,
           cast(null as double) as ratio, false as verified
    from orders""")
def typed_constants(t: Tables) -> DataFrame:
    return project.with_constants(t.orders.select("o_orderkey"), {
        "user_id": (12, "int"), "repository_type": (None, "string"), "photo": ("", "string"),
        "ratio": (None, "double"), "verified": (False, "boolean")})


@query("""
    select o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), '') as o_orderpriority,
           coalesce(nullif(o_orderdate, timestamp '1995-01-01'), timestamp '2024-06-01') as last_update
    from orders""")
def null_defaults(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr("o_orderkey", "nullif(o_orderpriority, '5-LOW') as o_orderpriority",
                               "nullif(o_orderdate, timestamp_ntz '1995-01-01') as last_update")
    now = F.lit("2024-06-01").cast("timestamp_ntz")
    return project.with_defaults(rows, {"o_orderpriority": "", "last_update": now})


@query("""
    select p_partkey, p_brand as brand_name, p_size as _2nd_size,
           regexp_replace(regexp_replace(regexp_replace(lower(label), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'),
                          '^([0-9])', '_\\1') as label_slug
    from (select *, p_size || ' - ' || coalesce(nullif(p_name, 'red widget'), '') || ' / ' || p_brand as label from part)""")
def slugify_values(t: Tables) -> DataFrame:
    """Slugs of values, and of column names."""
    label = F.concat(F.col("p_size").cast("string"), F.lit(" - "),
                     F.coalesce(F.expr("nullif(p_name, 'red widget')"), F.lit("")), F.lit(" / "), F.col("p_brand"))
    rows = t.part.select("p_partkey", F.col("p_brand").alias("Brand Name"), F.col("p_size").alias("2nd Size!"),
                         text.slugify(label).alias("Label-Slug"))
    return project.slugify_columns(rows)


@query("""
    select o_orderkey, o_orderstatus, o_orderpriority from orders
    where lower(o_orderpriority) like '%e%' and o_orderstatus in ('F', 'O')
      and not lower(o_orderpriority) like '%med%' and nullif(o_custkey, 3) is not null""")
def filter_like_in(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    return t.orders.filter(
        priority.ilike("%E%") & F.col("o_orderstatus").isin("F", "O") & ~priority.ilike("%Med%")
        & F.expr("nullif(o_custkey, 3L)").isNotNull()).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""
    select o_orderkey, o_orderdate from orders where year(o_orderdate) = 1997""")
def year_range_filter(t: Tables) -> DataFrame:
    return (t.orders.filter(dates.in_year_of(F.col("o_orderdate"), dt.date(1997, 6, 30)))
            .select("o_orderkey", "o_orderdate"))


@query("""
    select event_id,
           case when label ilike '%delivered%' then 'Delivered' when label ilike '%detain at custom%' then 'Detained'
                when label ilike '%transit%' then 'In Transit'
                when label ilike '%received at ware%' then 'ReceivedWarehouse'
                when label ilike '%out for deliver%' then 'Out For Delivery'
                else 'Received' end as status,
           case when label ilike 'out for delivery' then 'OutForDelivery'
                when label ilike 'detained at customs' then 'Detained' when label ilike '%transit%' then 'In Transit'
                when label ilike 'received at warehouse' then 'ReceivedWareHouse'
                else 'Received' end as package_status
    from (select event_id, case event_type when 'view' then 'IN TRANSIT to site' when 'purchase' then 'Out for Delivery'
                 when 'signup' then 'Received At Warehouse' when 'error' then 'Detained at Customs' end as label
          from events)""")
def status_recode(t: Tables) -> DataFrame:
    """Both status tables of the migration, over texts derived from the event type."""
    label = F.expr("""case event_type when 'view' then 'IN TRANSIT to site' when 'purchase' then 'Out for Delivery'
                      when 'signup' then 'Received At Warehouse' when 'error' then 'Detained at Customs' end""")
    return t.events.select(
        "event_id", text.recode(label, L.EVENT_STATUS_ARMS, L.DEFAULT_STATUS).alias("status"),
        text.recode(label, L.PACKAGE_STATUS_ARMS, L.DEFAULT_STATUS).alias("package_status"))


@query("""
    select event_id, case when word = 'yes' then 1 else 0 end as when_yes,
           case when word = 'no' then 0 else 1 end as unless_no
    from (select event_id, case event_type when 'view' then 'yes' when 'click' then 'no' when 'signup' then 'yes'
                 when 'error' then 'maybe' end as word from events)""")
def flag_rules(t: Tables) -> DataFrame:
    """NULL is 0 under one rule and 1 under the other; case and trailing blanks do not count."""
    word = F.expr("""case event_type when 'view' then 'YES ' when 'click' then 'No' when 'signup' then 'yes'
                     when 'error' then 'maybe' end""")
    return t.events.select("event_id", text.flag_when(word, "yes").alias("when_yes"),
                           text.flag_unless(word, "no").alias("unless_no"))


@query("""
    select c_custkey, left(c_name, 3) as prefix, substring(c_name, 5, 12) as middle, left(c_name, 255) as whole,
           case when lower(left(c_name, 3)) = 'cus' then 1 else 0 end as is_cus
    from customer""")
def substr_parts(t: Tables) -> DataFrame:
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey", F.left(name, F.lit(3)).alias("prefix"), F.substring(name, 5, 12).alias("middle"),
        text.fixed_width(name, 255).alias("whole"), text.flag_when(F.left(name, F.lit(3)), "CUS").alias("is_cus"))


@query("""
    select p_partkey, label,
           case when label ilike 'castries' then 1 when label ilike '%rb %' then 2
                when label ilike '%vf %' then 5 when label ilike 'miami' then 6 end as location_id,
           try_cast(nullif(regexp_extract(label, '(RB|VF) (AREA|BOX|SHELF) *([0-9]+)', 3, 'i'), '') as bigint)
               as storage_id,
           case when label ilike '%area%' then 'AREA' when label ilike '%box%' then 'BOX'
                when label ilike '%shelf%' then 'SHELF' end as storage_type
    from (select p_partkey, case p_type when 'ECONOMY' then 'RB AREA ' || substring(p_brand, 7)
                 when 'LARGE' then 'vf shelf' || substring(p_brand, 7) when 'PROMO' then 'VF BOX'
                 when 'MEDIUM' then 'Castries' when 'STANDARD' then 'BOX ' || p_size end as label from part)""")
def parse_storage_label(t: Tables) -> DataFrame:
    parts = t.part.selectExpr("p_partkey", """
        case p_type when 'ECONOMY' then 'RB AREA ' || substring(p_brand, 7)
             when 'LARGE' then 'vf shelf' || substring(p_brand, 7) when 'PROMO' then 'VF BOX'
             when 'MEDIUM' then 'Castries' when 'STANDARD' then 'BOX ' || p_size end as label""")
    label = F.col("label")
    return parts.select(
        "p_partkey", "label", text.recode(label, L.LOCATION_ARMS).alias("location_id"),
        text.storage_number(label, L.STORAGE_SITES, L.STORAGE_KINDS).cast("bigint").alias("storage_id"),
        text.storage_kind(label, L.STORAGE_KINDS).alias("storage_type"))


@query("""
    select p_partkey, coalesce(street, '') || coalesce(' ' || brand, '') || coalesce(' ' || p_type, '') as line,
           coalesce(street, '') || coalesce(brand, '') || p_size as joined
    from (select *, nullif(p_name, 'red widget') as street, nullif(p_brand, 'Brand#2') as brand from part)""")
def concat_address(t: Tables) -> DataFrame:
    """A missing first part leaves a leading blank."""
    rows = t.part.selectExpr("*", "nullif(p_name, 'red widget') as street", "nullif(p_brand, 'Brand#2') as brand")
    return rows.select("p_partkey", text.address(*map(F.col, ("street", "brand", "p_type"))).alias("line"),
                       text.join_text(*map(F.col, ("street", "brand", "p_size"))).alias("joined"))


@query("select p_partkey, upper(p_name) as name from part")
def upper_trim(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  \t"), F.col("p_name"), F.lit(" \n"))
    return t.part.select("p_partkey", text.upper_trim(padded).alias("name"))


@query("""
    select p_partkey, case when p_size > 25 then p_size else -1 end as number,
           cast(p_size as decimal(11,0)) as code, cast(p_retailprice as decimal(19,4)) as money
    from part""")
def try_cast_default(t: Tables) -> DataFrame:
    word = F.expr("case when p_size > 25 then cast(p_size as string) when p_size > 10 then p_name end")
    return t.part.select("p_partkey", text.int_or(word, -1).alias("number"),
                         F.col("p_size").cast("decimal(11,0)").alias("code"),
                         F.col("p_retailprice").cast("decimal(19,4)").alias("money"))


@query(f"""
    select o_orderkey,
           md5(concat(cast(o_orderkey as varchar), '-', o_orderstatus, '-',
               coalesce(nullif(o_orderpriority, '5-LOW'), '{NULL_TOKEN}'))) as key,
           md5(concat(cast(o_orderkey as varchar), '-', coalesce(nullif(o_orderpriority, '5-LOW'), ''))) as empty_key
    from orders""")
def surrogate_key(t: Tables) -> DataFrame:
    low = F.expr("nullif(o_orderpriority, '5-LOW')")
    return t.orders.select(
        "o_orderkey", key_of(F.col("o_orderkey"), F.col("o_orderstatus"), low).alias("key"),
        key_of(F.col("o_orderkey"), low, nulls_as_empty=True).alias("empty_key"))


URL_SQL = """
    select page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''),
                    'https://', ''), '/', 1), '?', 1) as url_host,
           split_part(case when strpos(bare, '/') > 0 then substring(bare, strpos(bare, '/') + 1)
                           when strpos(bare, '?') > 0 then substring(bare, strpos(bare, '?')) else bare end,
                      '?', 1) as url_path,
           nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') as page,
           nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') as ref
    from (select page_id, url, replace(replace(url, 'http://', ''), 'https://', '') as bare from pages)"""


@query(URL_SQL)
def url_parts(t: Tables) -> DataFrame:
    return urls.with_url_parts(t.pages.select("page_id", "url"), "url", ("page", "ref")).drop("url")


@query(f"""
    select url_host, count(*) as n_pages, count(page) as n_paged, count(distinct url_path) as n_paths
    from ({URL_SQL}) group by url_host""")
def url_parts_by_host(t: Tables) -> DataFrame:
    parts = urls.with_url_parts(t.pages.select("url"), "url", ("page",))
    return parts.groupBy("url_host").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count("page").alias("n_paged"),
        F.count_distinct("url_path").alias("n_paths"))


@query("""
    select event_id, case when event_type <> 'view' and event_type <> 'click' then date_trunc('second', ts) end as moment
    from events""")
def combine_date_time(t: Tables) -> DataFrame:
    """A date and a time text, each missing for one event type."""
    day = F.expr("if(event_type = 'view', null, cast(ts as date))")
    clock = F.expr("if(event_type = 'click', null, date_format(ts, 'HH:mm:ss'))")
    return t.events.select("event_id", dates.combine(day, clock).alias("moment"))


@query("""
    select o_orderkey, o_orderdate + interval 1 month as next_month, o_orderdate - interval 36 hour as before,
           cast(o_orderdate + interval 1 year as date) as valid_until, date_trunc('quarter', o_orderdate) as quarter
    from orders""")
def date_arith(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", dates.shift(day, "month", 1).alias("next_month"), dates.shift(day, "hour", -36).alias("before"),
        dates.shift_date(day, "year", 1).alias("valid_until"),
        F.date_trunc("quarter", day).cast("timestamp_ntz").alias("quarter"))


@query("""
    select l_returnflag, round(sum(l_extendedprice / nullif(l_discount, 0)), 2) as ratio_sum,
           count(l_extendedprice / nullif(l_discount, 0)) as n_ratios, count(*) as n_lines
    from lineitem group by l_returnflag""")
def safe_divide(t: Tables) -> DataFrame:
    ratio = numbers.safe_divide(F.col("l_extendedprice"), F.col("l_discount"))
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.sum(ratio), 2).alias("ratio_sum"), F.count(ratio).alias("n_ratios"),
        F.count(F.lit(1)).alias("n_lines"))


@query("""
    select p_partkey, coalesce(nullif(p_size, 7), 0) + coalesce(p_partkey, 0) + coalesce(nullif(p_size, 9), 0) as added,
           coalesce(p_partkey, 0) - coalesce(nullif(p_size, 7), 0) - coalesce(nullif(p_size, 9), 0) as subtracted
    from part""")
def safe_add_sub(t: Tables) -> DataFrame:
    key, a, b = F.col("p_partkey"), F.expr("nullif(p_size, 7)"), F.expr("nullif(p_size, 9)")
    return t.part.select("p_partkey", numbers.safe_add([a, key, b]).alias("added"),
                         numbers.safe_subtract([key, a, b]).alias("subtracted"))


@query("""
    select case when l_extendedprice < 20000 then 0 when l_extendedprice >= 80000 then 7
                else cast(floor((l_extendedprice - 20000) / 10000) as bigint) + 1 end as bucket, count(*) as n_lines
    from lineitem group by 1""")
def width_bucket_hist(t: Tables) -> DataFrame:
    bucket = numbers.width_bucket(F.col("l_extendedprice"), 20000, 80000, 6)
    return t.lineitem.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_lines"))


@query("""
    select o_orderkey, least(ceil((cast(round(o_totalprice / 500) * 500 as double) - 20000) / 30000), 7)
               + (case when cast(round(o_totalprice / 500) * 500 as bigint) % 30000 = 0 then 1 else 0 end) as bucket
    from orders""")
def width_bucket_by_formula(t: Tables) -> DataFrame:
    """Prices rounded to 500, many of them on an edge and beyond the last bucket."""
    price = F.round(F.col("o_totalprice") / 500) * 500
    return t.orders.select("o_orderkey", numbers.width_bucket(price, 20000, 200000, 6, compat=True).cast("double").alias("bucket"))


@query("""
    select o.o_orderkey, round(2 * 3961 * asin(sqrt(least(1.0, power(sin(radians((s.lat - c.lat) / 2)), 2)
               + cos(radians(c.lat)) * cos(radians(s.lat)) * power(sin(radians((s.lon - c.lon) / 2)), 2)))), 4) as miles,
           round(1.60934 * 2 * 3961 * asin(sqrt(least(1.0, power(sin(radians((s.lat - c.lat) / 2)), 2)
               + cos(radians(c.lat)) * cos(radians(s.lat)) * power(sin(radians((s.lon - c.lon) / 2)), 2)))), 4) as km
    from orders o
    join (select c_custkey, c_nationkey * 6.5 - 78 as lat, c_acctbal / 60 as lon from customer) c
      on c.c_custkey = o.o_custkey
    join (select s_suppkey, s_nationkey * 5.5 - 70 as lat, s_acctbal / 90 as lon from supplier) s
      on s.s_suppkey = o.o_custkey""")
def haversine_pairs(t: Tables) -> DataFrame:
    """Distance between the invented places of an order's customer and of the supplier of the same number."""
    customers = t.customer.selectExpr("c_custkey", "c_nationkey * 6.5D - 78 as lat1", "c_acctbal / 60 as lon1")
    suppliers = t.supplier.selectExpr("s_suppkey", "s_nationkey * 5.5D - 70 as lat2", "s_acctbal / 90 as lon2")
    pairs = (t.orders.join(customers, F.col("c_custkey") == F.col("o_custkey"))
             .join(suppliers, F.col("s_suppkey") == F.col("o_custkey")))
    pairs = numbers.with_distance(pairs, "lat1", "lon1", "lat2", "lon2", name="miles")
    pairs = numbers.with_distance(pairs, "lat1", "lon1", "lat2", "lon2", "km", "km")
    return pairs.select("o_orderkey", F.round("miles", 4).alias("miles"), F.round("km", 4).alias("km"))
