"""Every check with a passing and a failing case, and its NULL rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborline.operators import checks, suite
from harborline.operators.suite import Check


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def ints(spark, *values, name="v"):
    return frame(spark, f"{name} int", *[(v,) for v in values])


def test_not_null_and_unique(spark, rows):
    assert rows(checks.not_null(ints(spark, 1, None), "v")) == [(None,)]
    assert rows(checks.not_null(ints(spark, 1), "v")) == []
    assert rows(checks.unique(ints(spark, 1, 1, 2, None, None), "v")) == [(1, 2)]


def test_unique_combination_counts_nulls_together(spark, rows):
    df = frame(spark, "m string, p string, n int", ("a", "x", 1), ("a", "y", 2), (None, "x", 3))
    assert rows(checks.unique_combination_of_columns(df, ["m", "p"])) == []
    assert rows(checks.unique_combination_of_columns(df.union(df.filter("m is null")), ["m", "p"])) == [(None, "x", 2)]


def test_relationships(spark, rows):
    child, parent = ints(spark, 1, 2, 4, 4, None), ints(spark, 1, 2, None, name="id")
    assert rows(checks.relationships(child, "v", parent, "id")) == [(4,), (4,)]
    assert rows(checks.relationships_where(child, "v", parent, "id", "v <> 4")) == []
    assert rows(checks.relationships_where(child, "v", parent, "id", "v <> 4", "id <> 2")) == [(2,)]


def test_multi_column_relationship(spark, rows):
    df = frame(spark, "a int, b string", (1, "x"), (1, "y"), (1, "y"), (None, "x"), (2, None))
    to = frame(spark, "k int, l string", (1, "x"))
    assert rows(checks.multi_column_relationship(df, to, ["a", "b"], ["k", "l"])) == [(1, "y")]


def test_value_lists(spark, rows):
    df = frame(spark, "c string", ("a",), ("b",), ("b",), (None,))
    assert rows(checks.accepted_values(df, "c", ["a"])) == [("b", 2)]
    assert rows(checks.accepted_values(df, "c", ["a", "b"])) == []
    assert rows(checks.not_accepted_values(df, "c", ["b", "z"])) == [("b",)]
    assert rows(checks.not_accepted_values(df, "c", ["z"])) == []


def test_accepted_range(spark, rows):
    df = ints(spark, -1, 11, None)
    assert rows(checks.accepted_range(df, "v", -1, 11)) == []
    assert rows(checks.accepted_range(df, "v", -2, 11.1, inclusive=False)) == []
    assert rows(checks.accepted_range(df, "v", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert rows(checks.accepted_range(df, "v", min_value=0)) == [(-1,)]
    assert rows(checks.accepted_range(df, "v")) == []
    pairs = frame(spark, "v int, top int", (1, 2), (3, 2), (3, None))
    assert rows(checks.accepted_range(pairs, "v", max_value=F.col("top"))) == [(3, 2)]


def test_at_least_one(spark, rows):
    df = frame(spark, "g string, v int", ("a", 1), ("a", None), ("b", None))
    assert rows(checks.at_least_one(df, "v")) == []
    assert rows(checks.at_least_one(df, "v", ["g"])) == [("b", 0)]
    assert rows(checks.at_least_one(df.filter("false"), "v")) == [(0,)]
    assert rows(checks.at_least_one(df.filter("g = 'b'"), "v")) == [(0,)]


def test_cardinality_equality(spark, rows):
    a, b = ints(spark, 1, 1, 2), ints(spark, 1, 2, 1, name="w")
    assert rows(checks.cardinality_equality(a, "v", b, "w")) == []
    assert rows(checks.cardinality_equality(a, "v", ints(spark, 1, 2, name="w"), "w")) == [(1, 1), (1, 2)]


def test_row_counts(spark, rows):
    a = frame(spark, "g string", ("x",), ("x",), ("y",))
    b = frame(spark, "g string", ("x",), ("z",), ("z",), ("y",))
    assert rows(checks.equal_rowcount(a, b)) == [(3, 4, 1)]
    assert rows(checks.equal_rowcount(a, b, ["g"])) == [
        (None, "z", None, 2, None), ("x", "x", 2, 1, 1), ("y", "y", 1, 1, 0)]
    strict = checks.equal_rowcount(a, b, ["g"], strict=True)
    assert sorted(r.diff_count for r in strict.collect()) == [0, 1, 2]
    assert rows(checks.fewer_rows_than(a, b)) == [(3, 4, 0)]
    assert rows(checks.fewer_rows_than(a, a)) == [(3, 3, 1)]
    assert [r.row_count_delta for r in checks.fewer_rows_than(a, b, ["g"]).orderBy("g_a").collect()] == [0, 1, 1]
    strict = checks.fewer_rows_than(b, a, ["g"], strict=True).collect()
    assert {r.g_a: r.row_count_delta for r in strict} == {"x": 0, "y": 1, "z": 2}


def test_equality(spark, rows):
    a = frame(spark, "col_a int, col_b int, col_c int", (1, 1, 3), (1, 2, 1), (2, 3, 3))
    b = frame(spark, "col_a int, col_b int, COL_C int", (1, 1, 2), (1, 2, 2), (2, 3, 3))
    assert len(rows(checks.equality(a, b))) == 4
    assert rows(checks.equality(a, b, exclude_columns=["COL_c"])) == []
    assert rows(checks.equality(a, b, compare_columns=["col_a", "col_b"])) == []
    with pytest.raises(ValueError):
        checks.equality(a, b, compare_columns=["col_a"], exclude_columns=["col_b"])
    with pytest.raises(ValueError):
        checks.equality(a, b.drop("col_b"))


def test_equality_with_precision(spark, rows):
    a = frame(spark, "id string, x double, n int", ("p", 62.3888186, 1), ("q", 81.2511656, 2), ("r", None, 3))
    b = a.withColumn("x", F.col("x") + 0.0000001).withColumn("other", F.lit("z"))
    assert rows(checks.equality(a, b, exclude_columns=["other"], precision=4)) == []
    assert len(rows(checks.equality(a, b, exclude_columns=["other"], precision=7))) == 4
    assert rows(checks.equality(a, b, compare_columns=["ID", "x"], precision=4)) == []
    assert len(rows(checks.equality(a, b, exclude_columns=["other"], precision=0))) == 4


def test_expression_is_true(spark, rows):
    df = frame(spark, "col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert rows(checks.expression_is_true(df, "col_a + col_b = 1")) == []
    assert rows(checks.expression_is_true(df, "= 0.5", column="col_a")) == [(0.0, 1.0), (1.0, 0.0)]
    assert rows(checks.expression_is_true(df, "col_a = 0 or col_b = 0")) == [(0.5, 0.5)]


def ranges(spark, *data):
    return frame(spark, "k int, lo int, hi int", *data)


def failing(df):
    return sorted((r.lower_bound, r.upper_bound) for r in df.collect() if r.lower_bound is not None)


def test_mutually_exclusive_ranges(spark):
    joined = ranges(spark, (1, 0, 1), (1, 1, 2), (1, 2, 4))
    run = lambda df, **kw: failing(checks.mutually_exclusive_ranges(df, "lo", "hi", **kw))
    assert run(joined, gaps="not_allowed") == [] and run(joined) == []
    assert run(joined, gaps="required") == [(0, 1), (1, 2)]
    gappy = ranges(spark, (1, 0, 1), (1, 3, 4), (2, 0, 2), (2, 3, None))
    assert run(gappy, partition_by="k") == [(3, None)]
    assert failing(checks.mutually_exclusive_ranges(gappy, "lo", "coalesce(hi, 99)", "k", "required")) == []
    assert run(gappy.filter("hi is not null"), partition_by="k", gaps="not_allowed") == [(0, 1)]
    overlap = ranges(spark, (1, 0, 5), (1, 3, 6))
    assert run(overlap) == [(0, 5)] and run(ranges(spark, (1, 0, 5), (2, 3, 6)), partition_by="k") == []
    zero = ranges(spark, (1, 1, 1), (1, 2, 3))
    assert run(zero) == [(1, 1)] and run(zero, zero_length_range_allowed=True) == []
    assert run(ranges(spark, (1, 5, 4))) == [(5, 4)]
    with pytest.raises(ValueError):
        run(zero, gaps="sometimes")


def test_ranges_with_null_bound_fail(spark):
    df = ranges(spark, (1, None, 3), (1, 4, 5))
    found = checks.mutually_exclusive_ranges(df, "lo", "hi").collect()
    assert [(r.lower_bound, r.upper_bound) for r in found] == [(None, 3)]


def test_not_constant(spark, rows):
    df = frame(spark, "g string, v int", ("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None))
    assert rows(checks.not_constant(df, "v", ["g"])) == [("a", 1)]
    assert rows(checks.not_constant(df, "v")) == []
    assert rows(checks.not_constant(df.filter("g = 'a'"), "v")) == [(1,)]


def test_not_empty_string(spark, rows):
    df = frame(spark, "s string", ("a",), ("   ",), ("",), (None,))
    assert rows(checks.not_empty_string(df, "s")) == [("",), ("   ",)]
    assert rows(checks.not_empty_string(df, "s", trim_whitespace=False)) == [("",)]


def test_not_null_proportion(spark, rows):
    df = frame(spark, "g string, v int", *[("a", i if i < 5 else None) for i in range(10)], ("b", 1))
    assert rows(checks.not_null_proportion(df.filter("g = 'a'"), "v", 0.5, 0.5)) == []
    assert rows(checks.not_null_proportion(df, "v", 0.9, group_by=["g"])) == [("a", 0.5)]
    assert rows(checks.not_null_proportion(df, "v", 0.1, 0.9, group_by=["g"])) == [("b", 1.0)]
    assert rows(checks.not_null_proportion(df.filter("false"), "v", 0.9)) == []


def test_recency(spark, rows):
    df = spark.sql("select * from values ('a', timestamp_ntz'2024-01-30 00:00:00'), ('b', null) t(g, at)")
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    old, limit = dt.datetime(2024, 1, 30), dt.datetime(2024, 1, 30, 12)
    assert rows(checks.recency(df, "at", "day", 1, now)) == [(old, limit)]
    assert rows(checks.recency(df, "at", "day", 1, now, ignore_time_component=True)) == []
    assert rows(checks.recency(df, "at", "hour", 36, now)) == []
    assert rows(checks.recency(df, "at", "hour", 35, now, group_by=["g"]))[0][0] == "a"
    assert rows(checks.recency(df.filter("false"), "at", "day", 1)) == []


def test_sequential_values(spark, rows):
    df = frame(spark, "g int, v int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10), (2, None))
    assert rows(checks.sequential_values(df, "v", 2, group_by=["g"])) == [] and rows(checks.sequential_values(df, "v", 2)) == []
    assert rows(checks.sequential_values(df, "v", 1, group_by=["g"])) == [(1, 4, 2), (1, 6, 4), (2, 10, 8)]
    assert rows(checks.sequential_values(ints(spark, 1, 1, 2), "v")) == [(1, 1)]
    hours = spark.sql("select explode(array(0, 1, 2, 4)) h").selectExpr("timestamp_ntz'2021-01-01' + make_dt_interval(0, h) at")
    assert rows(checks.sequential_values(hours, "at", 1, "hour")) == [
        (dt.datetime(2021, 1, 1, 4), dt.datetime(2021, 1, 1, 2))]


def test_columns_match_set(spark, rows):
    df = frame(spark, "id int, Name string", (1, "a"))
    assert rows(checks.columns_match_set(df, ["ID", "name"])) == []
    assert rows(checks.columns_match_set(df, ["id", "size"])) == [("NAME", "a"), ("SIZE", "b")]


def test_assert_equal(spark, rows):
    df = frame(spark, "a int, e int", (1, 1), (1, 2), (None, 1))
    assert rows(checks.assert_equal(df, "a", "e")) == [(1, 2)]


# The suite.


def tables(spark):
    return {"t": frame(spark, "id int, s string, v double", (1, "a", 1.0), (2, "", 5.0), (2, None, 9.0), (None, "b", None)),
            "u": frame(spark, "id int", (1,))}


def test_suite_agrees_with_single_checks(spark):
    specs = [
        Check("nn", "t", "not_null", {"column": "id"}), Check("un", "t", "unique", {"column": "id"}),
        Check("es", "t", "not_empty_string", {"column": "s"}),
        Check("ar", "t", "accepted_range", {"column": "v", "max_value": 4}),
        Check("aw", "t", "accepted_range", {"column": "v", "max_value": 4}, where="id = 1"),
        Check("ex", "t", "expression_is_true", {"expression": "v < 6"}),
        Check("rel", "t", "relationships", {"column": "id", "to": "u", "field": "id"}),
        Check("one", "t", "at_least_one", {"column": "v"}), Check("one.w", "t", "at_least_one", {"column": "v"}, where="id is null"),
        Check("con", "t", "not_constant", {"column": "id"}), Check("con`w", "t", "not_constant", {"column": "id"}, where="v > 4"),
        Check("rc", "t", "equal_rowcount", {"compare": "u"}), Check("few", "t", "fewer_rows_than", {"compare": "u"}),
        Check("grp", "t", "at_least_one", {"column": "v", "group_by": ["s"]}),
    ]
    got = {r.check: r.failures for r in suite.run_suite(tables(spark), specs).collect()}
    single = {c.name: suite.failing_rows(c, tables(spark)).count() for c in specs}
    assert got == {**single, "rc": 3, "few": 3}
    assert got["nn"] == 1 and got["rel"] == 2 and got["one.w"] == 1 and got["con`w"] == 1 and got["aw"] == 0


def test_suite_severity_and_thresholds(spark):
    args = {"column": "id"}
    specs = [Check("a", "t", "not_null", args), Check("b", "t", "not_null", args, severity="warn"),
             Check("c", "t", "not_null", args, error_if="> 5"), Check("d", "t", "not_null", args, error_if="> 5", warn_if="> 5"),
             Check("e", "t", "not_null", args, error_if="<1", warn_if="<1"),
             Check("f", "t", "unique", args, fail_calc="max(n_records) * 10")]
    got = {r.check: (r.failures, r.status) for r in suite.run_suite(tables(spark), specs).collect()}
    assert got == {"a": (1, "error"), "b": (1, "warn"), "c": (1, "warn"), "d": (1, "pass"), "e": (1, "pass"), "f": (20, "error")}


def test_suite_equality_number(spark):
    both = {"a": ints(spark, 1, 2, 3), "b": ints(spark, 3)}
    result = suite.run_suite(both, [Check("eq", "a", "equality", {"compare": "b"})]).first()
    assert result.failures == 4  # two rows, and two more on one side than on the other


def test_suite_reads_each_table_once_for_fused_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    tables(spark)["t"].write.parquet(path)
    specs = [Check(f"c{i}", "t", "accepted_range", {"column": "v", "max_value": i}) for i in range(20)]
    plan = suite.run_suite({"t": spark.read.parquet(path)}, specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_suite_rejects_bad_specs(spark):
    for bad in ({"kind": "nothing"}, {"severity": "fatal"}, {"error_if": "1; drop"}):
        with pytest.raises(ValueError):
            Check(**{"name": "x", "table": "t", "kind": "not_null", "args": {"column": "id"}, **bad})
    same = Check("x", "t", "not_null", {"column": "id"})
    with pytest.raises(ValueError):
        suite.run_suite(tables(spark), [same, same])


def test_own_check_and_stored_failures(spark, tmp_path):
    suite.register_check("is_even", lambda df, column: df.filter(F.col(column) % 2 != 0))
    spec = Check("even", "t", "is_even", {"column": "id"})
    assert suite.run_suite(tables(spark), [spec]).first().failures == 1
    paths = suite.store_failures(tables(spark), [spec], str(tmp_path))
    assert spark.read.parquet(paths["even"]).first().id == 1
