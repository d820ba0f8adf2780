"""Joins, lookups and comparisons of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators import joins, setops
from harborline.operators.aggregate import distinct_ci
from workload.registry import Tables, query


@query("""
    select p.p_type, l.l_returnflag, count(*) as n_lines, sum(cast(l.l_quantity as bigint))::bigint as quantity
    from lineitem l join part p on p.p_partkey = l.l_partkey
    group by p.p_type, l.l_returnflag""")
def join_inner(t: Tables) -> DataFrame:
    return (t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
            .groupBy("p_type", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")))


@query("""
    select o.o_orderkey, c.c_custkey, c.c_name
    from orders o join customer c on o.o_custkey = c.c_custkey and c.c_mktsegment = 'BUILDING'""")
def join_inner_const_side(t: Tables) -> DataFrame:
    """The side condition filters the dimension before the join."""
    building = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    return (t.orders.join(building, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_custkey", "c_name"))


@query("""
    select event_id, user_id from events
    where user_id in (select c_custkey from customer where c_acctbal > 0)""")
def semi_known_keys(t: Tables) -> DataFrame:
    known = t.customer.filter("c_acctbal > 0")
    return joins.keep_known(t.events.select("event_id", "user_id"), known, {"user_id": "c_custkey"})


@query("""
    select d.doc_id, d.source from documents d
    where not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def find_missing(t: Tables) -> DataFrame:
    return joins.find_missing(t.documents.select("doc_id", "source"), t.labels, ["doc_id"])


@query("""
    select l.l_orderkey, l.l_linenumber, nullif(l.l_linenumber, 7) as line_key, l.l_returnflag from lineitem l
    where not exists (select 1 from lineitem r where r.l_returnflag = 'R' and r.l_orderkey = l.l_orderkey
                      and r.l_linenumber = nullif(l.l_linenumber, 7))""")
def find_missing_two_keys(t: Tables) -> DataFrame:
    """Lines whose order and number have no returned line; a NULL number matches nothing."""
    returned = t.lineitem.filter("l_returnflag = 'R'")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.expr("nullif(l_linenumber, 7)").alias("line_key"),
                              "l_returnflag")
    return joins.find_missing(lines, returned, {"l_orderkey": "l_orderkey", "line_key": "l_linenumber"})


@query("""
    select o_orderkey, o_custkey from orders
    where o_custkey not in (select c_custkey from customer where c_acctbal < 9000)
      and o_custkey not in (select s_suppkey from supplier where s_acctbal > 100000)""")
def not_in_list(t: Tables) -> DataFrame:
    """NOT IN a list without NULLs, then NOT IN an empty list."""
    poor = t.customer.filter("c_acctbal < 9000")
    orders = joins.not_in(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", poor, "c_custkey")
    return joins.not_in(orders, "o_custkey", t.supplier.filter("s_acctbal > 100000"), "s_suppkey")


@query("""
    select count(*) as n_left from orders
    where o_custkey not in (select nullif(c_custkey, 5) from customer)""")
def not_in_with_null(t: Tables) -> DataFrame:
    """One NULL in the list leaves no row."""
    listed = t.customer.select(F.expr("nullif(c_custkey, 5)").alias("c_custkey"))
    return joins.not_in(t.orders, "o_custkey", listed, "c_custkey").agg(F.count(F.lit(1)).alias("n_left"))


@query("""
    with a as (select nullif(l_returnflag, 'N') as flag, count(*) as count_a from lineitem
               where l_shipdate < timestamp '1998-01-01' group by 1),
         b as (select nullif(l_returnflag, 'N') as flag, count(*) as count_b from lineitem
               where l_returnflag <> 'A' group by 1)
    select a.flag as flag_a, b.flag as flag_b, count_a, count_b from a full join b on a.flag = b.flag""")
def full_join_counts(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("flag", F.expr("nullif(l_returnflag, 'N')"))
    return joins.side_by_side_counts(lines.filter("l_shipdate < timestamp_ntz '1998-01-01'"),
                                     lines.filter("l_returnflag <> 'A'"), ["flag"])


@query("""
    with a as (select distinct o_custkey as account from orders where o_orderstatus = 'F'),
         b as (select distinct o_custkey as account from orders where o_orderstatus = 'P')
    select coalesce(a.account, b.account) as account, case when b.account is null then 'a' else 'b' end as side
    from a full join b on a.account = b.account where a.account is null or b.account is null""")
def one_sided_rows(t: Tables) -> DataFrame:
    accounts = t.orders.select(F.col("o_custkey").alias("account"), "o_orderstatus")
    return joins.one_sided_keys(accounts.filter("o_orderstatus = 'F'"), accounts.filter("o_orderstatus = 'P'"),
                                ["account"])


@query("""
    with c as (select c_custkey, c_nationkey as nationkey, nullif(c_mktsegment, 'BUILDING') as segment from customer),
         d as (select n_nationkey as nationkey, nullif(m.segment, 'FURNITURE') as segment, n_name
               from nation join (select distinct c_nationkey, c_mktsegment as segment from customer) m
                 on m.c_nationkey = n_nationkey)
    select nationkey, segment, c_custkey, n_name from c natural join d""")
def natural_join(t: Tables) -> DataFrame:
    """Two shared columns; rows with a NULL in one of them drop out."""
    customers = t.customer.selectExpr("c_custkey", "c_nationkey as nationkey",
                                      "nullif(c_mktsegment, 'BUILDING') as segment")
    segments = t.customer.select("c_nationkey", "c_mktsegment").distinct()
    markets = (t.nation.join(segments, F.col("n_nationkey") == F.col("c_nationkey"))
               .selectExpr("n_nationkey as nationkey", "nullif(c_mktsegment, 'FURNITURE') as segment", "n_name"))
    return joins.natural_join(customers, markets)


@query("""
    select o_orderkey, o_orderpriority, m.id as priority_id
    from orders left join (values ('1-URGENT', 1::bigint), ('2-HIGH', 2), ('3-medium  ', 3)) m(code, id)
      on lower(o_orderpriority) = lower(rtrim(m.code))""")
def decode_lookup(t: Tables) -> DataFrame:
    ids = {"1-URGENT": 1, "2-HIGH": 2, "3-medium  ": 3}
    return joins.decode(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ids, "priority_id", ci=True)


@query("""
    select o.o_orderkey, nullif(o.o_custkey, 1) as account, c.c_name as account_name
    from orders o left join customer c on c.c_custkey = nullif(o.o_custkey, 1) and c.c_acctbal > 0""")
def decode_lookup_table(t: Tables) -> DataFrame:
    """The lookup is a table of any size with unique keys."""
    orders = t.orders.selectExpr("o_orderkey", "nullif(o_custkey, 1L) as account")
    return joins.decode(orders, "account", t.customer.filter("c_acctbal > 0"), "account_name",
                        key="c_custkey", value="c_name")


@query("""
    select o_orderkey, o_totalprice, 'none' as missing from orders
    where o_totalprice > 2 * (select min(o_totalprice) + 200000 from orders)""")
def scalar_broadcast(t: Tables) -> DataFrame:
    """A one-row query as a scalar; the default stands in for a query without rows."""
    floor = joins.single_value(t.orders.agg(F.min("o_totalprice") + 200000))
    nothing = joins.single_value(t.orders.filter("o_totalprice < 0").select("o_orderstatus"), "none")
    return (t.orders.filter(F.col("o_totalprice") > 2 * floor)
            .select("o_orderkey", "o_totalprice", nothing.alias("missing")))


@query("""
    select c_custkey as id, c_name as name, 'customer' as kind from customer
    union all select s_suppkey, s_name, 'supplier' from supplier""")
def union_all(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                  F.lit("customer").alias("kind"))
    return customers.union(t.supplier.select("s_suppkey", "s_name", F.lit("supplier")))


@query("""
    select 'parts' as origin, p_partkey as id, p_name as name, cast(p_size as varchar) as size,
           cast(null as double) as balance
    from part where p_name <> 'red widget'
    union all
    select 'suppliers', s_suppkey, s_name, null, s_acctbal from supplier""")
def union_relations(t: Tables) -> DataFrame:
    parts = t.part.selectExpr("p_partkey as id", "p_name as name", "p_size as size", "p_brand as brand")
    suppliers = t.supplier.selectExpr("s_suppkey as id", "s_name as name", "s_acctbal as balance",
                                      "s_nationkey as Brand")
    return setops.union_relations({"parts": parts, "suppliers": suppliers}, {"size": "string"}, exclude=["BRAND"],
                                  source_column_name="origin", where="name <> 'red widget'")


@query("""
    with a as (select o_custkey, nullif(o_orderpriority, '5-LOW') as priority from orders
               where o_orderdate < timestamp '1998-06-01'),
         b as (select o_custkey, nullif(o_orderpriority, '5-LOW') as priority from orders
               where o_orderdate >= timestamp '1998-06-01')
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
    union all
    select 'b_minus_a', * from (select * from b except select * from a)""")
def symmetric_except(t: Tables) -> DataFrame:
    pairs = t.orders.selectExpr("o_custkey", "nullif(o_orderpriority, '5-LOW') as priority", "o_orderdate")
    early = pairs.filter("o_orderdate < timestamp_ntz '1998-06-01'")
    late = pairs.filter("o_orderdate >= timestamp_ntz '1998-06-01'")
    return setops.symmetric_difference(early, late, ["o_custkey", "priority"])


@query("""
    with a as (select o_custkey as account, count(*) as num_rows from orders where o_orderstatus <> 'P' group by 1),
         b as (select o_custkey as account, count(*) as num_rows from orders where o_orderstatus <> 'F' group by 1)
    select * from (select * from a except select * from b)
    union all select * from (select * from b except select * from a)""")
def cardinality_diff(t: Tables) -> DataFrame:
    a = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("account"))
    return setops.count_difference(a, "account", t.orders.filter("o_orderstatus <> 'F'"), "o_custkey")


@query("""
    select min(word) as word from (
        select case when p_size > 25 then upper(p_name) || '  ' else p_name end as word from part)
    group by lower(rtrim(word))""")
def distinct_text_ci(t: Tables) -> DataFrame:
    words = t.part.selectExpr("case when p_size > 25 then upper(p_name) || '  ' else p_name end as word")
    return distinct_ci(words, "word")
