import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborline.operators import aggregate, joins, project, series, setops


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# Projections.


def test_star_and_filtered_columns(spark):
    df = frame(spark, "field_1 string, Field_2 string, field_3 string", ("a", "b", "c"))
    assert project.columns_except(df, ["FIELD_2"]) == ["field_1", "field_3"]
    assert df.select(project.star(df, ["field_3"], "x_", "_y")).columns == ["x_field_1_y", "x_Field_2_y"]
    assert project.star(df, ["field_1", "field_2", "field_3"]) == []
    joined = df.alias("a").join(df.alias("b"), F.col("a.field_1") == F.col("b.field_1"))
    assert joined.select(project.star(df, ["field_1"], relation_alias="b")).columns == ["Field_2", "field_3"]
    grouped = df.groupBy(*project.star(df, ["field_3"])).agg(F.max("field_3").alias("m"))
    assert grouped.columns == ["field_1", "Field_2", "m"]


def test_empty_to_null(spark, rows):
    df = frame(spark, "a string, b string, n int", ("", "x", 0), (" ", "", 1))
    assert rows(project.empty_to_null(df)) == [(None, "x", 0), (" ", None, 1)]
    assert rows(project.empty_to_null(df, ["B"])) == [("", "x", 0), (" ", None, 1)]


def test_constants_defaults_and_conform(spark):
    df = frame(spark, "a int, b string", (1, None))
    out = project.with_defaults(project.with_constants(df, {"c": (None, "decimal(11,0)"), "d": (7, "int")}), {"b": "z"})
    assert tuple(out.first()) == (1, "z", None, 7)
    assert out.schema["c"].dataType.simpleString() == "decimal(11,0)"
    shaped = project.conform(out, frame(spark, "D bigint, x string, a string", (1, "", "")).schema)
    assert shaped.columns == ["D", "x", "a"] and tuple(shaped.first()) == (7, None, "1")


def test_slugify_columns(spark):
    df = spark.range(1).select(F.lit(1).alias("First Name"), F.lit(2).alias("2nd-One!"))
    assert project.slugify_columns(df).columns == ["first_name", "_2nd_one"]


# Joins.


def test_find_missing_null_rules(spark, rows):
    left = frame(spark, "k int, v string", (1, "a"), (2, "b"), (None, "c"), (None, "d"))
    right = frame(spark, "k int", (1,), (None,))
    assert rows(joins.find_missing(left, right, ["k"])) == [(None, "c"), (None, "d"), (2, "b")]
    assert rows(joins.find_missing(left, right, ["k"], null_safe=True)) == [(2, "b")]
    assert rows(joins.keep_known(left, right, ["k"])) == [(1, "a")]


def test_key_comparison_without_case(spark, rows):
    left = frame(spark, "name string", ("Ab ",), ("É",), ("c",))
    right = frame(spark, "other string", ("aB",), ("e",))
    assert rows(joins.find_missing(left, right, {"name": "other"}, ci=True)) == [("c",), ("É",)]
    assert rows(joins.keep_known(left, right, {"name": "other"}, ci=True)) == [("Ab ",)]


def test_not_in(spark, rows):
    left = frame(spark, "k int", (1,), (2,), (None,))
    assert rows(joins.not_in(left, "k", frame(spark, "x int", (1,)), "x")) == [(2,)]
    assert rows(joins.not_in(left, "k", frame(spark, "x int", (1,), (None,)), "x")) == []
    assert rows(joins.not_in(left, "k", frame(spark, "x int"), "x")) == [(None,), (1,), (2,)]


def test_natural_join(spark, rows):
    a = frame(spark, "k int, g string, x int", (1, "a", 10), (2, None, 20), (3, "c", 30))
    b = frame(spark, "k int, g string, y int", (1, "a", 100), (2, None, 200), (3, "d", 300))
    assert rows(joins.natural_join(a, b)) == [(1, "a", 10, 100)]
    with pytest.raises(ValueError):
        joins.natural_join(a.select("x"), b.select("y"))


def test_decode(spark, rows):
    df = frame(spark, "c string", ("A",), ("b ",), ("z",), (None,))
    assert rows(joins.decode(df, "c", {"a": 1, "B": 2}, "id", ci=True)) == [(None, None), ("A", 1), ("b ", 2), ("z", None)]
    assert rows(joins.decode(df, "c", {"A": "x"}, "id"))[1] == ("A", "x")
    table = frame(spark, "code string, id int", ("A", 5), (None, 6))
    assert rows(joins.decode(df, "c", table, "id")) == [(None, None), ("A", 5), ("b ", None), ("z", None)]


def test_decode_wants_unique_keys(spark):
    df = frame(spark, "c string", ("a",))
    with pytest.raises(ValueError):
        joins.decode(df, "c", {"a": 1, "A ": 2}, "id", ci=True)
    twice = frame(spark, "code string, id int", ("a", 1), ("a", 2))
    with pytest.raises(Exception, match="keys that must be unique"):
        joins.decode(df, "c", twice, "id").collect()


def test_single_value(spark):
    df = frame(spark, "k int", (1,))
    one = lambda source, default: df.select(joins.single_value(source, default)).first()[0]
    assert one(frame(spark, "a int, b int", (7, 8)), 0) == 7
    assert one(frame(spark, "a int"), 9) == 9
    assert one(frame(spark, "a int", (None,)), 9) is None


def test_side_by_side_counts(spark, rows):
    a, b = frame(spark, "g string", ("x",), ("x",), (None,)), frame(spark, "g string", ("x",), ("y",), (None,))
    assert rows(joins.side_by_side_counts(a, b, ["g"])) == [
        (None, None, None, 1), (None, None, 1, None), (None, "y", None, 1), ("x", "x", 2, 1)]
    assert rows(joins.side_by_side_counts(a, b)) == [(3, 3)]
    assert rows(joins.side_by_side_counts(a, b.filter("g = 'none'"))) == [(3, None)]


def test_one_sided_keys(spark, rows):
    a, b = frame(spark, "k int", (1,), (1,), (2,), (None,)), frame(spark, "k int", (2,), (3,), (None,))
    assert rows(joins.one_sided_keys(a, b, ["k"])) == [(1, "a"), (3, "b")]


# Aggregates.


def test_column_values(spark):
    df = frame(spark, "f string, c string", *[(x, "left") for x in "aceg"], *[(x, "right") for x in "bdfgggg"])
    assert aggregate.value_list(df, "f") == ["g", "a", "b", "c", "d", "e", "f"]
    assert aggregate.value_list(df, "f", where="c = 'left'") == ["a", "c", "e", "g"]
    assert aggregate.value_list(df, "f", order_by=[F.desc("value")], max_records=2) == ["g", "f"]
    assert aggregate.value_list(df, "f", where="c = 'none'", default=["q"]) == ["q"]
    with pytest.raises(ValueError):
        aggregate.value_list(df, "f", max_values=3)
    with_null = frame(spark, "f string", (None,), ("a",))
    assert aggregate.value_list(with_null, "f") == [None, "a"]


def test_pivot(spark, rows):
    df = frame(spark, "size string, color string", ("S", "red"), ("S", "blue's"), ("S", "red"), ("M", "red"))
    out = aggregate.pivot(df, ["size"], "color", ["red", "blue's"])
    assert out.columns == ["size", "red", "blue's"] and rows(out) == [("M", 1, 0), ("S", 2, 1)]
    out = aggregate.pivot(df, ["size"], "color", ["red", "blue's"], quote_identifiers=False, prefix="n ", agg="max")
    assert out.columns == ["size", "n_red", "n_blues"] and rows(out) == [("M", 1, 0), ("S", 1, 1)]
    assert aggregate.pivot(df, ["size"], "color", ["red"], alias=False).columns[1].startswith("sum(")
    out = aggregate.pivot(df, ["size"], "color", ["c"], cmp=">=", agg="count", distinct=True, then_value=F.col("color"),
                          else_value=None)
    assert rows(out) == [("M", 1), ("S", 1)]


def test_unpivot(spark, rows):
    df = spark.sql("""select * from values (123, date'2017-01-01', 'active', true), (234, date'2017-02-01', null, null)
                      t(Customer_Id, created_at, Status, flag)""")
    out = aggregate.unpivot(df, exclude=["customer_id"], remove=["CREATED_AT"], field_name="prop", value_name="val")
    assert out.columns == ["Customer_Id", "prop", "val"]
    assert rows(out) == [(123, "Status", "active"), (123, "flag", "true"), (234, "Status", None), (234, "flag", None)]
    assert aggregate.unpivot(df.select("customer_id"), "int").columns == ["field_name", "value"]
    with pytest.raises(ValueError):
        aggregate.unpivot(df.select("status"), remove=["status"])


def test_best_row(spark, rows):
    df = frame(spark, "user_id int, event string, version int", (1, "play", 1), (1, "play", 2), (2, "pause", 1),
               (3, None, None), (3, None, None))
    out = aggregate.best_row(df, ["user_id"], [F.desc("version")])
    assert rows(out) == [(1, "play", 2), (2, "pause", 1), (3, None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "1, Partial" in plan and "1, Final" in plan


def test_distinct_ci(spark, rows):
    df = frame(spark, "n string", ("ab",), ("AB ",), ("Ab",), (None,), ("c",))
    assert rows(aggregate.distinct_ci(df, "n", "name")) == [(None,), ("AB ",), ("c",)]


def test_group_by_first(spark, rows):
    df = frame(spark, "a int, b int, c int", (1, 1, 5), (1, 1, 6), (1, 2, 7))
    assert rows(aggregate.group_by_first(df, 2).agg(F.sum("c").alias("s"))) == [(1, 1, 11), (1, 2, 7)]


# Sets.


def union_tables(spark):
    return {"t1": frame(spark, "id int, name string, favorite_number string", (1, "drew", "pi"), (2, "bob", "e")),
            "t2": frame(spark, "id int, favorite_color string, favorite_number int", (1, "green", 7))}


def test_union_relations(spark, rows):
    out = setops.union_relations(union_tables(spark))
    assert out.columns == ["source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert rows(out) == [("t1", 1, "drew", "pi", None), ("t1", 2, "bob", "e", None), ("t2", 1, None, "7", "green")]
    tables = union_tables(spark)
    out = setops.union_relations(tables, {"id": "string"}, include=["ID", "name"], source_column_name=None, where="id = 1")
    assert out.dtypes == [("id", "string"), ("name", "string")] and rows(out) == [("1", None), ("1", "drew")]
    assert "favorite_number" not in setops.union_relations(tables, exclude=["Favorite_Number"]).columns
    with pytest.raises(ValueError):
        setops.union_relations(tables, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        setops.union_relations(tables, include=["nothing"])


def test_symmetric_difference(spark, rows):
    a = frame(spark, "x int, y string", (1, "a"), (1, "a"), (2, None), (3, "c"))
    b = frame(spark, "x int, y string", (1, "a"), (2, None), (4, "d"), (4, "d"))
    assert rows(setops.symmetric_difference(a, b)) == [("a_minus_b", 3, "c"), ("b_minus_a", 4, "d")]


def test_count_difference(spark, rows):
    a, b = frame(spark, "v int", (1,), (1,), (2,), (None,)), frame(spark, "w int", (1,), (2,), (3,), (None,))
    assert rows(setops.count_difference(a, "v", b, "w")) == [(1, 1), (1, 2), (3, 1)]


# Series.


def test_number_series(spark):
    assert [r[0] for r in series.number_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        series.number_series(spark, 0)


def test_date_spine(spark):
    days = series.date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10))
    assert days.dtypes == [("date_day", "date")]
    assert [r[0] for r in days.orderBy("date_day").collect()] == [dt.date(2018, 1, d) for d in range(1, 10)]
    months = series.date_spine(spark, "month", dt.date(2024, 1, 31), dt.date(2024, 4, 1))
    assert [r[0] for r in months.collect()] == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    hours = series.date_spine(spark, "hour", dt.datetime(2024, 1, 1, 22), dt.datetime(2024, 1, 2, 1))
    assert [r[0].hour for r in hours.collect()] == [22, 23, 0]
    with pytest.raises(ValueError):
        series.date_spine(spark, "day", dt.date(2024, 1, 1), dt.date(2024, 1, 1))
