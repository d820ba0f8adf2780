"""Indexed tables, states of checks that merge, and comparison by checksums."""

import random

import pytest
from pyspark.sql import functions as F

from harborline.operators import check_state, indexed, setops
from harborline.operators.aggregate import top_values
from harborline.operators.load import read_current
from harborline.operators.suite import Check, run_suite
from harborline.sources.tables import like_tables

SCHEMA = "k long, s string, v int"


def table(rows):
    return sorted(((r.k, r.s, r.v) for r in rows.collect()), key=str)


def test_only_files_with_a_key_of_the_source_are_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i * 10, f"s{i % 3}", i) for i in range(2000)]
    made = indexed.create(spark.createDataFrame(rows, SCHEMA), path, ["k", "s"], rows_per_file=10)
    assert len(made.inputFiles()) > 150 and table(made) == sorted(rows, key=str)
    picks = [(30, "s0", -1), (31, "s0", -2), (5050, "s1", -3), (9990, "zz", -4), (19990, "s1", -5), (-7, "a", -6), (10**6, "b", -7), (None, "n", -8)]
    source = spark.createDataFrame(picks, SCHEMA)
    files = indexed.touched_files(spark, path, source)
    assert 3 <= len(files) <= 5
    assert len(indexed.read(spark, path, files).inputFiles()) == len(files)
    want = {(k, s): v for k, s, v in rows} | {(k, s): v for k, s, v in picks}
    merged = indexed.merge(spark, path, source, rows_per_file=10)
    assert table(merged) == sorted(((k, s, v) for (k, s), v in want.items()), key=str)
    for seed in range(3):  # ranges overlap more and more, and stay right
        rng = random.Random(seed)
        picks = {(rng.randrange(-5, 2010) * 10, f"s{rng.randrange(4)}"): rng.randrange(99) for _ in range(40)}
        want |= picks
        merged = indexed.merge(spark, path, spark.createDataFrame([(*k, v) for k, v in picks.items()], SCHEMA), rows_per_file=10)
    assert table(merged) == sorted(((k, s, v) for (k, s), v in want.items()), key=str)


def test_a_batch_counts_once_and_numbers_go_on(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "k long, v int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    indexed.create(spark.createDataFrame([], "k long, v int, id long"), path, ["k"])
    load = lambda rows, batch: indexed.append(spark, path, frame(rows), batch=batch, number="id", order_by=["k", "v"])
    load([(5, 1), (3, 1), (None, 1)], "one")
    load([(5, 2), (4, 2), (None, 2)], "two")
    again = load([(5, 2), (4, 2), (None, 2)], "two")  # NULL keys would be new every time
    assert sorted((r.id, r.k, r.v) for r in again.collect()) == [(1, None, 1), (2, 3, 1), (3, 5, 1), (4, None, 2), (5, 4, 2)]
    assert indexed.batch_rows(spark, path, "two") == 2 and indexed.batch_rows(spark, path, "three") is None

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(indexed, "write_version", dies)
        with pytest.raises(RuntimeError):
            load([(9, 3)], "three")
    assert indexed.batch_rows(spark, path, "three") is None and indexed.read(spark, path).count() == 5
    assert sorted(r.id for r in load([(9, 3), (8, 3)], "three").collect()) == list(range(1, 8))
    indexed.merge(spark, path, spark.createDataFrame([(9, 30, 7)], "k long, v int, id long"), batch="fix")
    assert sorted(r.id for r in load([(10, 4)], "four").collect()) == list(range(1, 9))


def some_checks():
    return [
        Check("k there", "t", "not_null", {"column": "k"}), Check("v small", "t", "accepted_range", {"column": "v", "max_value": 90}, warn_if="> 5"),
        Check("k once", "t", "unique", {"column": "k"}), Check("pair once", "t", "unique_combination_of_columns", {"columns": ["k", "s"]}),
        Check("s some", "t", "at_least_one", {"column": "s"}), Check("v varies", "t", "not_constant", {"column": "v"}),
        Check("s alike", "t", "not_constant", {"column": "s"}, where="k = 1"), Check("half", "t", "not_null_proportion", {"column": "s", "at_least": 0.99}),
        Check("fresh", "t", "recency", {"field": "at", "part": "day", "interval": 3, "now": F.lit("2024-01-20").cast("timestamp")}),
        Check("old", "t", "recency", {"field": "at", "part": "day", "interval": 30, "now": F.lit("2024-01-20").cast("timestamp")}),
    ]


def test_states_of_increments_merge_to_the_whole(spark, tmp_path):
    rng, checks = random.Random(5), some_checks()
    parts = [[(rng.choice([None, *range(40)]), rng.choice(["a", "b", None]), rng.randrange(100)) for _ in range(60)] for _ in range(3)]
    parts[0] += [(1, None, 1), (None, "1", 2)]
    frames = [spark.createDataFrame(p, SCHEMA).withColumn("at", F.lit(f"2024-01-0{i + 1}").cast("timestamp")) for i, p in enumerate(parts)]
    for i, frame in enumerate(frames):
        check_state.store_state(frame, checks, str(tmp_path / "s"), f"day {i}")
    check_state.store_state(frames[1], checks, str(tmp_path / "s"), "day 1")  # once more: replaces
    whole = frames[0].union(frames[1]).union(frames[2])
    order = lambda df: sorted(map(tuple, df.select("check", "failures", "status").collect()))
    assert order(check_state.checked(spark, str(tmp_path / "s"), checks)) == order(run_suite({"t": whole}, checks))
    assert read_current(spark, str(tmp_path / "s" / "day_1")).inputFiles()
    with pytest.raises(ValueError):
        check_state.state(frames[0], [Check("x", "t", "sequential_values", {"column": "k"})])


def test_difference_by_checksum(spark):
    rows = [(i, f"s{i % 5}" if i % 7 else None, i % 3) for i in range(3000)] + [(None, None, 1)] * 3
    a = spark.createDataFrame(rows, SCHEMA).repartition(3)
    same = spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)
    assert setops.difference_by_checksum(a, same, fanout=64).collect() == []
    changed = [r for r in rows if r[0] != 17] + [(18, "s3", 99), (None, "s1", None), rows[40], (None, None, 1)]
    b = spark.createDataFrame(changed, SCHEMA)
    for fanout in (1, 4, 4096):
        got = setops.difference_by_checksum(a, b, fanout=fanout)
        want = setops.symmetric_difference(a, b)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len(got.collect()) == 3
    empty = a.limit(0)
    assert setops.difference_by_checksum(a, empty).count() == setops.symmetric_difference(a, empty).count()
    assert setops.difference_by_checksum(empty, empty).count() == 0
    nulls = spark.createDataFrame([(None, "x", 1)], SCHEMA), spark.createDataFrame([(1, "x", None)], SCHEMA)
    assert setops.difference_by_checksum(*nulls).count() == 2


def test_checksums_of_both_tables_are_one_sum(spark, monkeypatch):
    """A task that merges the checksums holds one hash table of them; several would lie in its memory at once."""
    a = spark.createDataFrame([(i, f"s{i % 5}", i % 3) for i in range(500)] + [(None, "x", 1)] * 2, SCHEMA).repartition(3)
    b = a.withColumn("v", F.expr("if(k % 99 = 7, null, v)")).union(a.filter("k % 50 = 0"))
    plans, staged = [], setops.staged

    def seen(df, label):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return staged(df, label)

    monkeypatch.setattr(setops, "staged", seen)
    got = setops.difference_by_checksum(a, b, fanout=4)
    assert table_of_diff(got) == table_of_diff(setops.symmetric_difference(a, b)) and got.count() == 10
    assert [plan.count("HashAggregate(") for plan in plans] == [2, 2]  # where the rows are, and where their sums meet
    turned = setops.difference_by_checksum(b, a, fanout=4)
    assert table_of_diff(turned) == table_of_diff(setops.symmetric_difference(b, a))


def table_of_diff(rows):
    return sorted(map(str, rows.collect()))


def test_top_values_are_exact(spark):
    rng = random.Random(2)
    values = [None] * 30 + ["hot"] * 200 + [f"v{rng.randrange(400)}" for _ in range(3000)] + ["a", "b"]
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(4)
    count = {v: values.count(v) for v in set(values)}
    want = sorted(count.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    for k, cells in ((1, 64), (5, 4096), (12, 8), (1000, 16)):
        assert [tuple(r) for r in top_values(df, "c", k, cells).collect()] == want[:k]
    assert top_values(df.limit(0), "c", 3).collect() == []


def test_like_tables_take_one_scan_per_schema(spark, tmp_path):
    for i in range(12):
        df = spark.range(i, i + 3).withColumn("s", F.lit(str(i))) if i % 3 else spark.range(i, i + 2)
        df.repartition(2).write.parquet(str(tmp_path / f"day {i}.parquet"))
    got = like_tables(spark, str(tmp_path), "DAY%", exclude="%11")
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    want = sorted((f"day {i}", j, str(i) if i % 3 else None) for i in range(11) for j in range(i, i + (3 if i % 3 else 2)))
    assert sorted((r.source_relation, r.id, r.s) for r in got.collect()) == want
    with pytest.raises(ValueError):
        like_tables(spark, str(tmp_path), "none%")
