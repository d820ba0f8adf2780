"""Tables in buckets, and schemas that change."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.operators import bucketed, drift, indexed

SCHEMA = "k long, s string, v int, made string"


def table(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_merge_moves_no_row_of_the_target(spark):
    rows = [(i, f"s{i % 3}", i, "old") for i in range(500)] + [(None, "n", 1, "old"), (7, None, 2, "old")]
    bucketed.create(spark.createDataFrame(rows, SCHEMA), "buckets_one", ["k", "s"], 8)
    source = spark.createDataFrame([(3, "s0", None, "new"), (4, "s0", 5, "new"), (None, "n", 6, "new")], SCHEMA)
    after = plan(bucketed.merged(spark, "buckets_one", source))
    assert after.count("Exchange") == 1 and "Bucketed: true" in after and "SelectedBucketsCount: 8 out of 8" in after
    got = bucketed.merge(spark, "buckets_one", source)
    want = [r for r in rows if r[:2] != (3, "s0")] + [(3, "s0", None, "new"), (4, "s0", 5, "new"), (None, "n", 6, "new")]
    assert table(got) == sorted(want, key=str) == table(spark.table("buckets_one"))
    stored = bucketed.keyed(spark, "buckets_one")
    assert len(stored.inputFiles()) <= 8  # one file a bucket
    assert "Exchange" not in plan(stored.groupBy("k", "s").count())
    bucketed.create(got.select("k", "s", F.lit(1).alias("one")), "buckets_two", ["k", "s"], 8)
    with_hint = stored.hint("merge").join(bucketed.keyed(spark, "buckets_two"), ["k", "s"])
    assert "Exchange" not in plan(with_hint) and with_hint.count() == len(want) - 3


def test_merges_into_buckets_agree_with_a_dict(spark):
    rng = random.Random(3)
    want = {(k, "a"): (k, "a", k, "old") for k in range(60)}
    bucketed.create(spark.createDataFrame(list(want.values()), SCHEMA), "buckets_many", ["k", "s"], 4)
    for turn in range(3):
        picks = {(rng.randrange(90), rng.choice("ab")): rng.choice([None, 1, 2]) for _ in range(40)}
        source = spark.createDataFrame([(*key, v, f"turn {turn}") for key, v in picks.items()], SCHEMA)
        if turn == 1:
            source = source.drop("v")
        got = bucketed.merge(spark, "buckets_many", source, keep=["made"])
        for key, v in picks.items():
            old = want.get(key, (*key, None, f"turn {turn}"))
            want[key] = (*key, old[2] if turn == 1 else v, old[3])
    assert table(got) == sorted(want.values(), key=str)
    assert sum(t.name.startswith("buckets_many__") for t in spark.catalog.listTables()) == 4  # this version and the one before
    empty = bucketed.merge(spark, "buckets_many", source.limit(0))
    assert table(empty) == sorted(want.values(), key=str)


def test_repeated_keys_and_dead_jobs_leave_the_table(spark, monkeypatch):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(Exception, match="unique"):
        bucketed.create(frame([(1, "a", 1, "x"), (1, "a", 2, "x")]), "buckets_twice", ["k"], 2)
    bucketed.create(frame([]), "buckets_dead", ["k"], 2)
    assert bucketed.merge(spark, "buckets_dead", frame([(1, "a", 1, "x"), (None, "a", 1, "x"), (None, "a", 1, "x")])).count() == 3
    with pytest.raises(Exception, match="unique"):
        bucketed.merge(spark, "buckets_dead", frame([(2, "a", 1, "x"), (2, "a", 2, "x")]))
    assert spark.table("buckets_dead").count() == 3
    assert bucketed.merge(spark, "buckets_dead", frame([(2, "a", 1, "x")])).count() == 4
    spark.range(3).createOrReplaceTempView("no_buckets")
    with pytest.raises(Exception):
        bucketed.keyed(spark, "no_buckets")


WIDER = [
    ("tinyint", "smallint", "smallint"), ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "double", "double"),
    ("int", "double", "double"), ("smallint", "double", "double"), ("int", "decimal(12,2)", "decimal(12,2)"),
    ("decimal(9,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(12,2)", "decimal(30,4)", "decimal(30,4)"),
    ("decimal(10,2)", "decimal(10,4)", "decimal(12,4)"), ("bigint", "decimal(8,3)", "decimal(23,3)"),
    ("decimal(18,0)", "int", "decimal(18,0)"), ("date", "timestamp_ntz", "timestamp_ntz"), ("string", "string", "string")]


def test_files_are_read_as_the_wider_type(spark, tmp_path):
    """The first load lies in its files as it was written; nothing but its reading changes."""
    def load(key, kinds, value):
        return spark.sql(f"select {key}L as k, " + ", ".join(f"cast('{value(kind)}' as {kind}) as c{i}" for i, kind in enumerate(kinds)))

    old = load(1, [w[0] for w in WIDER], lambda kind: "2024-02-29" if kind == "date" else "77")
    new = load(2, [w[1] for w in WIDER], lambda kind: "2024-02-29 12:30:00" if kind == "timestamp_ntz" else
               "12.5" if "(" in kind or kind == "double" else "99")
    path = str(tmp_path / "t")
    indexed.create(old, path, ["k"])
    files = set(indexed.read(spark, path).inputFiles())
    got = indexed.append(spark, path, new, on_change="add")
    assert files < set(got.inputFiles()) and [kind for _, kind in got.dtypes[1:]] == [w[2] for w in WIDER]
    cast = [f"cast(c{i} as {w[2]}) as c{i}" for i, w in enumerate(WIDER)]
    assert table(got) == table(old.selectExpr("k", *cast).union(new.selectExpr("k", *cast)))


def test_columns_are_added_refused_or_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda sql: spark.sql(sql)
    indexed.create(frame("select id as k, cast(id as int) as v from range(6)"), path, ["k"], rows_per_file=2)
    more = frame("select id as K, id + 5000000000 as v, 'new' as Note, 1 as n from range(5, 8)")
    with pytest.raises(drift.SchemaChange, match="Note string is new"):
        indexed.merge(spark, path, more, on_change="refuse")
    assert indexed.read(spark, path).count() == 6
    got = indexed.merge(spark, path, more, on_change="add")
    assert got.dtypes == [("k", "bigint"), ("v", "bigint"), ("Note", "string"), ("n", "int")]
    assert table(got) == sorted([(i, i, None, None) for i in range(5)] + [(i, i + 5 * 10**9, "new", 1) for i in (5, 6, 7)], key=str)
    plain = indexed.append(spark, path, frame("select 9L as k, 'lost' as other"))  # ignored, as before
    assert table(plain.filter("k = 9")) == [(9, None, None, None)]
    for bad in ("select 10L as k, 'text' as v", "select 10L as k, null as hollow", "select cast(10 as decimal(38,0)) as k"):
        with pytest.raises(drift.SchemaChange):
            indexed.append(spark, path, frame(bad), on_change="add")
    with pytest.raises(ValueError, match="on_change"):
        indexed.append(spark, path, frame("select 10L as k"), on_change="sync")
    assert indexed.read(spark, path).count() == 9


def test_types_without_a_common_wider_one():
    assert drift.wider(T.LongType(), T.DoubleType()) is None  # a double does not hold every long
    assert drift.wider(T.StringType(), T.IntegerType()) is None
    assert drift.wider(T.DecimalType(38, 0), T.DecimalType(38, 10)) is None
    assert drift.wider(T.DecimalType(9, 2), T.DoubleType()) is None
    assert drift.wider(T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())) is None
    assert drift.wider(T.FloatType(), T.LongType()) is None and Decimal(2**53 + 1) != Decimal(float(2**53 + 1))
