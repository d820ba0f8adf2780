"""The order-dependent operators against plain Python, with ranges small enough to need seams."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from harborline.operators import ordered

SIZES = [100_000, 40]


def hot_rows(n=1500, seed=3):
    """A third of the rows in one group, a third of those with one value."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.4 else f"g{rng.randrange(60)}", 7 if rng.random() < 0.4 else rng.randrange(500))
            for _ in range(n)]


def neighbours(rows, step):
    out = []
    for _, group in groupby(sorted(rows), key=lambda r: r[0]):
        group = list(group)
        for i, (g, v) in enumerate(group):
            j = i + step
            out.append((g, v, group[j][1] if 0 <= j < len(group) else None))
    return out


@pytest.mark.parametrize("size", SIZES)
def test_neighbours_with_hot_group_and_equal_rows(spark, size):
    data = hot_rows()
    df = spark.createDataFrame(data, "g string, v int").repartition(7)
    for function, step in ((ordered.with_previous, -1), (ordered.with_next, 1)):
        got = function(df, ["v"], ["v"], ["g"], name="n", rows_per_range=size).select("g", "v", "n.v").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, neighbours(data, step)))


@pytest.mark.parametrize("size", SIZES)
def test_neighbours_without_groups(spark, size):
    data = [(i, i * 3 % 1000) for i in range(1000)]
    df = spark.createDataFrame(data, "k int, v int").repartition(5, "k")
    got = {r.v: (r.k, r.n) for r in ordered.with_next(df, ["v"], ["v"], name="n", rows_per_range=size)
           .select("k", "v", F.col("n.v").alias("n")).collect()}
    assert {v: n for v, (_, n) in got.items()} == {v: v + 1 if v < 999 else None for v in range(1000)}


def test_missing_neighbour_differs_from_null_value(spark):
    df = spark.sql("select * from values (1, null), (2, 5) t(k, v)")
    got = {r.k: (r.n is None) for r in ordered.with_previous(df, ["v"], ["k"], name="n").collect()}
    assert got == {1: True, 2: False}


def test_null_groups_belong_together(spark):
    df = spark.sql("select if(id < 3, null, 1) g, id v from range(6)")
    got = ordered.with_previous(df, ["v"], ["v"], ["g"], name="n", rows_per_range=2).select("v", "n.v").collect()
    assert sorted(tuple(r) for r in got if r[1] is not None) == [(1, 0), (2, 1), (4, 3), (5, 4)]


@pytest.mark.parametrize("size", SIZES)
def test_dense_ids_with_equal_rows(spark, size):
    data = hot_rows()
    df = spark.createDataFrame(data, "g string, v int").repartition(6)
    got = ordered.dense_ids(df, ["g", "v"], "id", rows_per_range=size).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, len(data) + 1))
    assert [(r.g, r.v) for r in got] == sorted(data)


def test_dense_ids_over_many_types(spark):
    df = spark.sql("""
        select if(id % 7 = 0, null, concat('o''neil \\\\ ', id % 5)) as s, if(id % 11 = 0, double('nan'), id / 3.0D) as x,
               cast(id as decimal(12,3)) as d, id % 2 = 0 as b, date_add(date'2024-01-01', cast(id % 9 as int)) as day,
               timestamp_micros(id * 1000001) as ts from range(900)""")
    order = ["s", "b", "day", "x", "ts", "d"]
    got = ordered.dense_ids(df, order, "id", rows_per_range=50).orderBy("id").drop("id").collect()
    assert str(got) == str(df.orderBy(*order).collect())


def test_dense_ids_start_and_empty_table(spark):
    df = spark.range(5).select(F.col("id").alias("k"))
    assert [r.n for r in ordered.dense_ids(df, ["k"], "n", start=10).orderBy("k").collect()] == [10, 11, 12, 13, 14]
    assert ordered.dense_ids(df.filter("k < 0"), ["k"], "n").collect() == []


def test_one_value_everywhere(spark):
    df = spark.sql("select 1 as v from range(500)")
    got = ordered.with_next(df, ["v"], ["v"], name="n", rows_per_range=20).select("n").collect()
    assert len(got) == 500 and sum(r.n is None for r in got) == 1
    ids = ordered.dense_ids(df, ["v"], "id", rows_per_range=20).collect()
    assert sorted(r.id for r in ids) == list(range(1, 501))


def wide_exchanges(df):
    """The single-partition exchanges of a plan, each with what feeds it."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "SinglePartition" in line]


@pytest.mark.parametrize("rows", [3, 5000])
def test_no_size_puts_the_rows_into_one_task(spark, rows):
    """Only one row per range goes to a single task: what feeds it is the aggregate by range, or of the bounds' sample."""
    df = spark.range(rows).select((F.col("id") % 3).alias("g"), "id")
    for result in (ordered.with_previous(df, ["id"], ["id"], ["g"]), ordered.with_next(df, ["id"], ["id"]),
                   ordered.dense_ids(df, ["id"], "n")):
        fed = wide_exchanges(result)
        assert fed and all("HashAggregate" in line or "SortAggregate" in line for line in fed), fed


def test_rows_are_written_once_and_move_once(spark):
    """The only exchange of rows is by the number of their range; the other ones follow an aggregate by range."""
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), "id")
    for result in (ordered.with_previous(df, ["id"], ["id"], ["g"]), ordered.with_next(df, ["id"], ["id"]),
                   ordered.dense_ids(df, ["id"], "n")):
        lines = result._jdf.queryExecution().executedPlan().toString().splitlines()
        after = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(__range" in line]
        assert sum("Aggregate" not in line for line in after) == 1, after


def test_in_ranges_keeps_a_range_whole_and_sorted(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "g string, v int").repartition(6)
    got = ordered.in_ranges(df, ["g", "v"], "at", rows_per_range=40).withColumn("p", F.spark_partition_id()).collect()
    assert len({(r["at"], r["p"]) for r in got}) == len({r["at"] for r in got}) > 10
    by_range = [(r.g, r.v) for r in sorted(got, key=lambda r: r["at"])]
    assert by_range == sorted(data)  # a stable sort: rows of a range come in their order


@pytest.mark.parametrize("kind", ["binary", "timestamp", "timestamp_ntz", "string", "decimal(20,4)"])
def test_ranges_are_even_for_every_kind_of_key(spark, kind, monkeypatch):
    monkeypatch.setenv("TZ", "America/Lima")
    key = {"binary": "cast(lpad(id, 8, '0') as binary)", "timestamp": "timestamp_micros(id * 3600000000)"}.get(
        kind, "timestamp_ntz '2000-01-01' + make_interval(0, 0, 0, 0, cast(id as int))" if kind == "timestamp_ntz"
        else f"cast(lpad(id, 8, '0') as {kind})")
    df = spark.range(4000).selectExpr(f"{key} as k", "id")
    ranged, _ = ordered._ranged(df, ["k"], 100)
    sizes = [r["count"] for r in ranged.groupBy("__range").count().collect()]
    assert len(sizes) >= 36 and max(sizes) <= 400
    got = ordered.dense_ids(df, ["k"], "n", rows_per_range=100).select("n", "id").collect()
    assert all(r.n == r.id + 1 for r in got) and len(got) == 4000


def test_input_is_evaluated_once(spark):
    df = spark.range(2000).select(F.expr("uuid()").alias("u"))
    got = ordered.dense_ids(df, ["u"], "n", rows_per_range=50).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 2001)) and [r.u for r in got] == sorted(r.u for r in got)


def test_rows_with_a_map(spark):
    df = spark.sql("select map('a', id % 2) as m, id % 3 as k from range(300)")
    got = ordered.dense_ids(df, ["k"], "n", rows_per_range=20).orderBy("n").collect()
    assert [r.k for r in got] == [0] * 100 + [1] * 100 + [2] * 100
