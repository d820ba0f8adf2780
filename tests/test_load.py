import pytest
from pyspark.sql import functions as F

from harborline import session
from harborline.operators import load


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_merge_by_key(spark, rows):
    target = frame(spark, "k int, v string", (1, "a"), (2, "b"), (None, "n"))
    source = frame(spark, "v string, k int, extra int", ("B", 2, 0), ("C", 3, 0), ("N", None, 0))
    assert rows(load.merge_by_key(target, source, ["k"])) == [(None, "N"), (None, "n"), (1, "a"), (2, "B"), (3, "C")]
    assert load.merge_by_key(None, source, ["k"]).columns == ["v", "k", "extra"]


def test_merge_fails_on_repeated_source_key(spark):
    target = frame(spark, "k int, v string", (1, "a"))
    source = frame(spark, "k int, v string", (2, "a"), (2, "b"))
    with pytest.raises(Exception, match="keys that must be unique"):
        load.merge_by_key(target, source, ["k"]).collect()
    assert load.merge_by_key(target, source, ["k"], check_unique=False).count() == 3
    nulls = frame(spark, "k int, v string", (None, "a"), (None, "b"))
    assert load.merge_by_key(target, nulls, ["k"]).count() == 3


def test_merge_without_case(spark, rows):
    target, source = frame(spark, "k string, v int", ("A ", 1), ("b", 2)), frame(spark, "k string, v int", ("a", 3))
    assert rows(load.merge_by_key(target, source, ["k"], ci=True)) == [("a", 3), ("b", 2)]
    with pytest.raises(Exception, match="keys that must be unique"):
        load.merge_by_key(target, source.union(frame(spark, "k string, v int", ("A", 4))), ["k"], ci=True).collect()


def test_composite_key(spark, rows):
    target = frame(spark, "a int, b int, v string", (1, 1, "x"), (1, 2, "y"))
    source = frame(spark, "a int, b int, v string", (1, 2, "Y"), (2, 1, "Z"))
    assert rows(load.merge_by_key(target, source, ["a", "b"])) == [(1, 1, "x"), (1, 2, "Y"), (2, 1, "Z")]


def test_upsert(spark, rows):
    target = frame(spark, "k int, name string, born string, own int", (1, "a", "1980", 7), (2, "b", "1990", 8), (None, "n", "0", 9))
    source = frame(spark, "k int, name string, born string", (2, None, "1900"), (3, "c", "1901"), (None, "m", "1902"))
    assert rows(load.upsert(target, source, ["k"], ["BORN"])) == [
        (None, "m", "1902", None), (None, "n", "0", 9), (1, "a", "1980", 7), (2, None, "1990", 8), (3, "c", "1901", None)]


def test_new_rows(spark, rows):
    target, source = frame(spark, "k int, v string", (1, "a"), (None, "n")), frame(spark, "k int, v string", (1, "z"), (2, "b"), (None, "n"))
    assert rows(load.new_rows(target, source, ["k"])) == [(None, "n"), (2, "b")]
    assert rows(load.new_rows(target, source, ["k"], null_safe=True)) == [(2, "b")]
    assert load.new_rows(None, source, ["k"]).count() == 3


def test_new_rows_pruned_by_a_key(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, "k int, day int", (1, 1), (2, 5), (3, None), (4, 9)).write.parquet(path)
    target, source = spark.read.parquet(path), frame(spark, "k int, day int", (1, 1), (2, 4), (2, 5), (3, None))
    out = load.new_rows(target, source, ["k", "day"], prune_by="day")
    assert rows(out) == [(2, 4), (3, None)]
    assert "LessThanOrEqual(day,5)" in out._jdf.queryExecution().executedPlan().toString()
    assert rows(load.new_rows(target, source, ["k", "day"], null_safe=True, prune_by="day")) == [(2, 4)]
    assert rows(load.new_rows(target, source.filter("day is null"), ["k", "day"], prune_by="day")) == [(3, None)]
    with pytest.raises(ValueError):
        load.new_rows(target, source, ["k"], prune_by="day")


def test_append_new_first_run_then_increment(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first, second = frame(spark, "k int, v string", (1, "a")), frame(spark, "k int, v string, w int", (1, "z", 0), (2, "b", 0))
    assert rows(load.append_new(spark, first, path, ["k"])) == [(1, "a")]
    assert rows(load.append_new(spark, second, path, ["k"])) == [(1, "a"), (2, "b")]
    assert rows(load.append_new(spark, second, path, ["k"])) == [(1, "a"), (2, "b")]
    assert load.append_new(spark, second, path, ["k"], full_refresh=True).columns == ["k", "v", "w"]


def test_append_counted(spark, tmp_path):
    path = str(tmp_path / "t")
    assert load.append_counted(spark.range(7), path) == 7
    assert load.append_counted(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 10


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    assert load.read_current(spark, root) is None
    load.write_version(spark.range(3), root)
    load.write_version(load.read_current(spark, root).withColumn("id", F.col("id") + 10), root)
    assert sorted(r.id for r in load.read_current(spark, root).collect()) == [10, 11, 12]
    (tmp_path / "t" / "v=00000003").mkdir()  # a version whose job died
    assert load.read_current(spark, root).count() == 3
    assert load.write_version(spark.range(1), root).endswith("v=00000004")
    assert load.read_current(spark, root).count() == 1


def test_merge_touched_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, "day int, k int, v string", (1, 1, "a"), (2, 1, "b"), (2, 2, "c")).write.partitionBy("day").parquet(path)
    untouched = next((tmp_path / "t" / "day=1").glob("*.parquet"))
    stamp = untouched.stat().st_mtime_ns
    source = frame(spark, "day int, k int, v string", (2, 2, "C"), (3, 1, "d"))
    for _ in range(2):
        out = load.merge_touched_partitions(spark, path, source, ["day", "k"], "day")
        assert rows(out.select("day", "k", "v")) == [(1, 1, "a"), (2, 1, "b"), (2, 2, "C"), (3, 1, "d")]
    assert untouched.stat().st_mtime_ns == stamp
    with pytest.raises(ValueError):
        load.merge_touched_partitions(spark, path, source, ["k"], "day")


def test_identity(spark, rows):
    df = frame(spark, "v string", ("b",), ("a",), ("c",))
    out = load.add_identity(df, ["v"], "id", "decimal(11,0)")
    assert out.schema["id"].dataType.simpleString() == "decimal(11,0)"
    assert [(r.v, int(r.id)) for r in out.orderBy("v").collect()] == [("a", 1), ("b", 2), ("c", 3)]


def test_view(spark):
    load.as_view(spark.range(2), "two")
    assert spark.table("two").count() == 2


def test_staging_is_under_the_named_folder(spark, tmp_path):
    class Context:
        applicationId, master = "app-1", "local[2]"

    class Session:
        conf = {"spark.checkpoint.dir": "/shared/", "spark.sql.warehouse.dir": "/house"}
        sparkContext = Context()

    assert session.staging_root(Session()) == "/shared/harborline-app-1"
    del Session.conf["spark.checkpoint.dir"]
    assert session.staging_root(Session()) == "/house/_staging/harborline-app-1"
    Context.master = "yarn"  # the warehouse may be a folder of the driver's machine
    with pytest.raises(ValueError):
        session.staging_root(Session())
    assert session.staging_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_staged_copies_can_be_dropped(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "staging_root", lambda _: str(tmp_path / "own"))
    copy = session.staged(spark.range(4))
    assert copy.count() == 4 and list((tmp_path / "own").iterdir())
    assert session.drop_staged(spark) and not (tmp_path / "own").exists()


def days_table(spark, path):
    rows = [(d, k, "old") for d in range(10) for k in range(4)]
    frame(spark, "day int, k int, v string", *rows).repartition(4).write.partitionBy("day").parquet(path)


def test_merge_reads_touched_partitions_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    days_table(spark, path)
    plans, real = [], load.merge_by_key

    def spy(target, source, keys):
        plans.append(target._jdf.queryExecution().executedPlan().toString())
        folders = target.select(F.regexp_extract(F.input_file_name(), "day=([^/]*)", 1).alias("d")).distinct().collect()
        assert [r.d for r in folders] == ["3"]
        return real(target, source, keys)

    monkeypatch.setattr(load, "merge_by_key", spy)
    source = spark.range(30, 32).selectExpr("cast(id / 10 as int) as day", "cast(id % 10 as int) as k", "'new' as v")
    out = load.merge_touched_partitions(spark, path, source, ["day", "k"], "day")
    pruned = next(line for line in plans[0].splitlines() if "PartitionFilters" in line)
    assert "= 3)" in pruned.split("PartitionFilters")[1].split("]")[0] and len(plans) == 1
    assert sorted(r.v for r in out.filter("day = 3").collect()) == ["new", "new", "old", "old"] and out.count() == 40


def test_merge_survives_death_before_and_during_the_swap(spark, tmp_path, monkeypatch):
    import shutil

    path = str(tmp_path / "t")
    days_table(spark, path)
    source = frame(spark, "day int, k int, v string", (3, 0, "new"), (20, 0, "new"), (None, 7, "new"))
    real = load.finish_merge
    monkeypatch.setattr(load, "finish_merge", lambda *_: False)  # dies once the note is there
    load.merge_touched_partitions(spark, path, source, ["day", "k"], "day")
    monkeypatch.setattr(load, "finish_merge", real)
    session.drop_staged(spark)  # the job that died cleans up behind itself; the merged rows are not among that
    assert spark.read.parquet(path).filter("v = 'new'").count() == 0  # nothing half done is to be seen
    shutil.rmtree(tmp_path / "t" / "day=3")  # or dies while partitions move
    later = frame(spark, "day int, k int, v string", (3, 1, "newer"))
    out = load.merge_touched_partitions(spark, path, later, ["day", "k"], "day")
    assert sorted((r.k, r.v) for r in out.filter("day = 3").collect()) == [(0, "new"), (1, "newer"), (2, "old"), (3, "old")]
    assert out.filter("day = 20 or day is null").count() == 2 and out.count() == 42
    assert not load.finish_merge(spark, path)


def test_upsert_is_one_join_with_two_shuffles(spark):
    target = spark.range(100).selectExpr("id", "id % 5 as v", "'t' as w")
    source = spark.range(50, 150).selectExpr("id", "id % 7 as v")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    plan = load.upsert(target, source, ["id"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(conf, before)
    assert (plan.count("Join"), plan.count("Exchange"), plan.count("Range (")) == (1, 2, 2), plan


def test_upsert_with_null_and_repeated_keys(spark, rows):
    target = frame(spark, "k int, v string, w string", (1, "a", "x"), (None, "n", "x"), (2, "b", "x"))
    source = frame(spark, "k int, v string", (1, None), (None, "m"), (None, "m"), (3, "c"))
    assert rows(load.upsert(target, source, ["k"])) == rows(frame(
        spark, "k int, v string, w string", (1, None, "x"), (None, "n", "x"), (2, "b", "x"), (None, "m", None), (None, "m", None), (3, "c", None)))
    with pytest.raises(Exception, match="must be unique"):
        load.upsert(target, frame(spark, "k int, v string", (1, "a"), (1, "b")), ["k"]).collect()
