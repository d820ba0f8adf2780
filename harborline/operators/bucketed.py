"""Tables stored in buckets of their key, merged bucket by bucket.

Rows with a full key lie hashed and sorted in a fixed number of buckets, so a merge shuffles its source only, and joins of
two tables with as many buckets, or groupings by the key, move no row.  Rows with a NULL in the key match nothing; they lie
beside, in no bucket, so that they don't pile up in one.

A view under the table's name shows both, and notes the keys and the tables behind it.  A merge writes new tables first and
replaces the view last: a job that dies leaves the table as it was, and readers of the version before can finish, as its
tables are dropped one merge later.  Merges of one table must not run at the same time.

A bucket is read by one task: choose their number so that one is some hundred MB.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.operators.joins import any_null
from harborline.operators.project import conform

NOTE = "harborline.bucketed"


def _noted(spark: SparkSession, name: str) -> dict:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == NOTE).collect()
    if not rows:
        raise ValueError(f"{name} is not a bucketed table of this library")
    return json.loads(rows[0]["value"])


def _once(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows by bucket; a repeated key fails the job.  It is counted within the same shuffle."""
    clash = F.raise_error(F.lit("keys that must be unique and are not")).cast("boolean")
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    placed = rows.repartition(buckets, *keys).withColumn("__times", times)
    return placed.filter(F.when(F.col("__times") == 1, F.lit(True)).otherwise(clash)).drop("__times")


def _commit(name: str, keyed: DataFrame, loose: DataFrame, keys: Sequence[str], buckets: int, before: Sequence[str]) -> DataFrame:
    spark, version = keyed.sparkSession, uuid.uuid4().hex
    parts = [f"{name}__keyed_{version}", f"{name}__loose_{version}"]
    keyed.write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(parts[0])
    loose.write.saveAsTable(parts[1])
    note = json.dumps({"keys": list(keys), "buckets": buckets, "parts": parts, "before": list(before)})
    shown = " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts)
    quoted = note.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{NOTE}' = '{quoted}') AS {shown}")
    return spark.table(name)


def create(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Stores ``df`` under ``name``, in so many buckets of ``keys``, which must be unique where they hold no NULL."""
    whole = ~any_null(keys)
    return _commit(name, _once(df.filter(whole), keys, buckets), df.filter(~whole), keys, buckets, [])


def keyed(spark: SparkSession, name: str) -> DataFrame:
    """The rows with a full key, in their buckets: for joins and groupings by the key."""
    return spark.table(_noted(spark, name)["parts"][0])


def merged(spark: SparkSession, name: str, source: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The rows with a full key after a merge with ``source``.

    A matched row takes the source's columns, also where they are NULL; it keeps those that the source lacks and those
    in ``keep``, which are written for new keys only.
    """
    note, old = _noted(spark, name), keyed(spark, name)
    keys, given = note["keys"], {c.lower() for c in source.columns}
    kept = {c.lower() for c in (*keep, *keys)}
    new = conform(source, old.schema).filter(~any_null(keys))
    ours, theirs = old.withColumn("__old", F.lit(True)).alias("t"), _once(new, keys, note["buckets"]).withColumn("__new", F.lit(True)).alias("s")
    match = reduce(and_, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys])

    def value(column: str):
        was, comes = F.col(f"t.`{column}`"), F.col(f"s.`{column}`")
        if column.lower() in kept or column.lower() not in given:
            return F.when(F.col("t.__old"), was).otherwise(comes).alias(column)
        return F.when(F.col("s.__new"), comes).otherwise(was).alias(column)

    return ours.join(theirs, match, "full").select([value(c) for c in old.columns])


def merge(spark: SparkSession, name: str, source: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Merges ``source`` into the table by its keys (see ``merged``); rows with a NULL in the key are added."""
    note = _noted(spark, name)
    loose = spark.table(note["parts"][1])
    loose = loose.union(conform(source, loose.schema).filter(any_null(note["keys"])))
    out = _commit(name, merged(spark, name, source, keep), loose, note["keys"], note["buckets"], note["parts"])
    for part in note["before"]:
        spark.sql(f"DROP TABLE IF EXISTS {part}")
    return out
