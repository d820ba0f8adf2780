import pytest
from pyspark.sql import types as T

from harborline.operators.setops import union_relations
from harborline.sources import files, tables


def test_json_lines(spark, rows, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1, "b": "x"}\n\n{"a": 2, "b": null}\n{"b": "y"}\n{"a": 3, "b": "z"\n{"a": "text", "b": "q"}\n[1]\n')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    good, rejects = files.read_json_lines(spark, str(path), schema, ["a", "b"], ["b"])
    assert rows(good) == [(1, "x")]
    assert {r.line: r.reason for r in rejects.collect()} == {
        '{"a": 2, "b": null}': "null: b", '{"b": "y"}': "missing: a", '{"a": 3, "b": "z"': "malformed",
        '{"a": "text", "b": "q"}': "malformed", "[1]": "malformed"}
    good, rejects = files.read_json_lines(spark, str(path), schema)
    assert good.count() == 3 and rejects.count() == 3


def test_json_is_read_and_parsed_once(spark, tmp_path, monkeypatch):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1, "b": "x"}\n')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    real, seen = files.staged, []

    def spy(df, *args):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args)

    monkeypatch.setattr(files, "staged", spy)
    good, rejects = files.read_json_lines(spark, str(path), schema, ["a"], ["a", "b"])
    assert [p.count("from_json") for p in seen] == [1] and [p.count("FileScan text") for p in seen] == [1]
    for half in (good, rejects):
        plan = half._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "FileScan text" not in plan and "PartitionFilters: [" in plan


def test_csv_seed(spark, rows, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_bytes(b"\xef\xbb\xbfid,name,at\n1,a,2020-01-02\n2,,\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("at", T.DateType())])
    out = rows(files.read_csv_seed(spark, str(path), schema))
    assert [(r[0], r[1], str(r[2])) for r in out] == [(1, "a", "2020-01-02"), (2, None, "None")]
    path.write_text("id,name,at\nx,a,2020-01-02\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv_seed(spark, str(path), schema).collect()


def test_tables_by_pattern(spark, rows, tmp_path):
    for schema, day in (("day_a", "20180101"), ("day_a", "20180102"), ("day_b", "20180103")):
        spark.sql(f"create database if not exists {schema}")
        spark.sql(f"select {day} as user_id, 'play' as event").write.saveAsTable(f"{schema}.data_events_{day}")
    found = tables.catalog_tables(spark, "DAY_%", "data_events_%")
    assert sorted(found) == ["day_a.data_events_20180101", "day_a.data_events_20180102", "day_b.data_events_20180103"]
    assert len(tables.catalog_tables(spark, "day_%", "data%", exclude="%0102")) == 2
    assert sorted(tables.catalog_tables_by_prefix(spark, "day_a", "DATA_")) == sorted(found)[:2]
    union = union_relations(found, exclude=["event"])
    assert rows(union)[0] == ("day_a.data_events_20180101", 20180101) and union.count() == 3
    root = str(tmp_path)
    for name in ("orders", "order_lines", "people"):
        spark.range(1).write.parquet(f"{root}/{name}.parquet")
    assert sorted(tables.stored_tables(spark, root, "ORDER%")) == ["order_lines", "orders"]
    assert sorted(tables.stored_tables(spark, root, "%", exclude="order_lines")) == ["orders", "people"]
    assert tables.read_table(spark, root, "people").count() == 1
