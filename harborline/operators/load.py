"""Loads: full refresh, keyed merge, upsert, append of new rows, identity columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from harborline.operators.joins import any_null, find_missing, keep_known, key_hash, require_unique
from harborline.operators.ordered import dense_ids
from harborline.operators.project import conform


def merge_by_key(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                 check_unique: bool = True, ci: bool = False) -> DataFrame:
    """Target after a merge: source rows replace target rows of the same key, the others are added.

    The first run has no target.  Afterwards the target's columns stay as they are.  A source row with a
    NULL key matches nothing and is always added.  ``ci`` compares text keys without case.
    """
    source = require_unique(source, keys, ci) if check_unique else source
    if target is None:
        return source
    return find_missing(target, source, keys, ci=ci).union(conform(source, target.schema))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], insert_only: Iterable[str] = (),
           check_unique: bool = True) -> DataFrame:
    """Target after an upsert in which the ``insert_only`` columns are written for new keys only.

    A matched row takes every other column from the source, even where that is NULL; a column that the source lacks
    stays.  One full join: each table is read and shuffled once.  A repeated source key fails the job; it is counted
    in the shuffle that the join needs anyway.  Where the target is partitioned, cut it down to the partitions of the
    source first (``merge_touched_partitions``), since a full join passes over all of it.
    """
    keep = {c.lower() for c in (*insert_only, *keys)}
    given = {c.lower() for c in source.columns}
    on = [*keys, "__match"]
    new = conform(source, target.schema)
    new = new.withColumn("__match", key_hash(new, keys))
    if check_unique:
        times = F.count(F.lit(1)).over(Window.partitionBy(*on))
        clash = F.raise_error(F.lit("keys that must be unique and are not")).cast("boolean")
        new = new.withColumn("__times", times).filter(
            F.when((F.col("__times") == 1) | any_null(keys), F.lit(True)).otherwise(clash)).drop("__times")
    old = target.withColumns({"__match": key_hash(target, keys), "__old": F.lit(True)}).alias("t")
    right = new.withColumn("__new", F.lit(True)).alias("s")
    match = reduce(and_, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in on])

    def merged(name: str):
        ours, theirs = F.col(f"t.`{name}`"), F.col(f"s.`{name}`")
        if name.lower() in keep:
            return F.when(F.col("t.__old"), ours).otherwise(theirs).alias(name)
        if name.lower() in given:
            return F.when(F.col("s.__new"), theirs).otherwise(ours).alias(name)
        return ours.alias(name)

    return old.join(right, match, "full").select([merged(c) for c in target.columns])


def new_rows(target: DataFrame | None, source: DataFrame, keys: Sequence[str], null_safe: bool = False,
             ci: bool = False, prune_by: str | None = None) -> DataFrame:
    """Source rows whose key the target lacks, in the target's columns; all of them on the first run.

    A NULL in the key matches nothing, so such rows are new every time unless ``null_safe``.  The target is
    first cut down to the keys of the source, as it is the larger side and the source is the one Spark may
    broadcast.  ``prune_by`` names a key column whose range in the source then limits the scan of the target.
    """
    if target is None:
        return source
    seen = target.select(*keys)
    if prune_by is not None:
        if prune_by not in keys:
            raise ValueError("prune_by must be one of the keys")
        inside = within(prune_by, *ends_of(source, F.col(prune_by)))
        seen = seen.filter(inside | F.col(prune_by).isNull() if null_safe else inside)
    seen = keep_known(seen, source, keys, null_safe, ci)
    return conform(find_missing(source, seen, keys, null_safe, ci), target.schema)


def ends_of(df: DataFrame, value: Column) -> tuple:
    """Smallest and largest value, by a job; None twice where there is none."""
    return tuple(df.agg(F.min(value), F.max(value)).first())


def within(column: str, low, high) -> Column:
    """``column`` between two driver-side values, in a form that reaches the scan; nothing is between NULLs."""
    return F.col(column).between(F.lit(low), F.lit(high))


def append_new(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
               null_safe: bool = False, prune_by: str | None = None, full_refresh: bool = False) -> DataFrame:
    """Append the new rows of ``source`` to the parquet table at ``path`` and return the table.

    The first run, and a full refresh, write the whole source.
    """
    if full_refresh or not path_exists(spark, path):
        source.write.mode("overwrite").parquet(path)
    else:
        fresh = new_rows(spark.read.parquet(path), source, keys, null_safe, prune_by=prune_by)
        fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def append_counted(df: DataFrame, path: str) -> int:
    """Append ``df`` to the parquet table at ``path`` and return how many rows were written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


def add_identity(df: DataFrame, order_by: Sequence[str], name: str, kind: str = "int") -> DataFrame:
    """Add a gapless identity column from 1, in the order of the given columns.

    The input is evaluated once, by jobs that run while the plan is built; see ``ordered``.
    """
    return dense_ids(df, order_by, name).withColumn(name, F.col(name).cast(kind))


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """Numbers of the versions under ``root`` in order, and whether each was written to its end."""
    fs, where = _file_system(spark, root)
    if not fs.exists(where):
        return []
    numbers = sorted(int(f.getPath().getName()[2:]) for f in fs.listStatus(where)
                     if f.getPath().getName().startswith("v="))
    return [(n, path_exists(spark, f"{_version(root, n)}/_SUCCESS")) for n in numbers]


def _version(root: str, number: int) -> str:
    return f"{root}/v={number:08d}"


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the next version of the table at ``root`` and return the version's path.

    ``df`` may read the current version: a version is never overwritten, and counts only once the job
    that wrote it has committed.
    """
    seen = _versions(df.sparkSession, root)
    path = _version(root, seen[-1][0] + 1 if seen else 1)
    # The rebalance hint evens out the files: small partitions share a task, a hot one is split.
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return path


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest complete version of the table at ``root``; None before the first."""
    complete = [n for n, done in _versions(spark, root) if done]
    return spark.read.parquet(_version(root, complete[-1])) if complete else None


PENDING, MERGED = "_merge_pending", "_merged"  # readers skip names that begin with an underscore


def merge_touched_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                             partition_column: str) -> DataFrame:
    """Merge into a partitioned parquet table, reading and rewriting only the partitions the source has rows for.

    The partition column must belong to the key, so a row never moves.  The values it takes in the source are
    fetched, one per partition that is rewritten, so that the scan of the target is pruned by constants.  The merged
    partitions are written to a folder beside the table first, and a note names them until they are in place:
    a job that dies in between is finished by the next one, or by ``finish_merge``, before anything else is read.
    """
    if partition_column not in keys:
        raise ValueError("the partition column must be one of the keys")
    finish_merge(spark, path)
    target = spark.read.parquet(path)
    values = [r[0] for r in source.select(partition_column).distinct().collect()]
    known = [v for v in values if v is not None]
    inside = F.col(partition_column).isin(known) if known else F.lit(False)
    if len(known) < len(values):
        inside = inside | F.col(partition_column).isNull()
    # The folders are listed again for these partitions alone.
    touched = target.filter(inside)
    merged = f"{path}/{MERGED}-{uuid.uuid4().hex}"  # beside the table: it stays as long as the note does
    merge_by_key(touched, source, keys).write.parquet(merged)
    _write_note(spark, f"{path}/{PENDING}", f"{partition_column}\n{merged}")
    finish_merge(spark, path)
    return spark.read.schema(target.schema).parquet(path)


def finish_merge(spark: SparkSession, path: str) -> bool:
    """Puts merged partitions in place that a note says are waiting; doing so twice gives the same table."""
    note = f"{path}/{PENDING}"
    if not path_exists(spark, note):
        return False
    fs, where = _file_system(spark, note)
    lines = spark._jvm.java.util.Scanner(fs.open(where), "UTF-8")
    column, merged = lines.nextLine(), lines.nextLine()
    lines.close()
    rows = spark.read.parquet(merged).hint("rebalance", column)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))
    fs.delete(where, False)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(merged), True)
    return True


def _write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there in full or not at all."""
    fs, where = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}_draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(draft, where)
