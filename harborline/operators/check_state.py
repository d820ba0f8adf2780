"""Checks of a growing table from stored partial results, so that an increment is checked without the rest.

``store_state`` reads one increment and writes what its checks need to know of it: counts, the ends of values, and a
128-bit digest with its count for every key that must be unique.  ``checked`` merges the states of all increments and
reports as ``run_suite`` does.  An increment that is stored again replaces its state.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.text import slugify_name
from harborline.operators import checks as C
from harborline.operators.load import _file_system, _version, _versions, write_version
from harborline.operators.suite import PREDICATES, Check, _kept, _status

KEYS = ("unique", "unique_combination_of_columns")
STATE = "check string, n long, some long, low string, high string, moment timestamp, k1 long, k2 long"


def _columns(check: Check) -> list[str]:
    return [check.args["column"]] if check.kind == "unique" else list(check.args["columns"])


def _numbers(check: Check) -> Column:
    """One row of state, as a struct of aggregates over the increment."""
    keep, nothing = _kept(check), F.lit(None)
    n, some, low, high, moment = F.lit(0), F.lit(0), nothing, nothing, nothing
    if check.kind in PREDICATES:
        n = F.count_if(keep & PREDICATES[check.kind](**check.args))
    elif check.kind in ("at_least_one", "not_null_proportion", "not_constant"):
        value = F.when(keep, F.col(check.args["column"]))
        n, some, low, high = F.count_if(keep), F.count(value), F.min(value).cast("string"), F.max(value).cast("string")
    elif check.kind == "recency":
        moment = F.max(F.when(keep, F.col(check.args["field"]))).cast("timestamp")
    else:
        raise ValueError(f"a check {check.kind!r} has no state that merges")
    return F.struct(F.lit(check.name).alias("check"), n.cast("long").alias("n"), some.cast("long").alias("some"),
                    low.cast("string").alias("low"), high.cast("string").alias("high"), moment.cast("timestamp").alias("moment"),
                    nothing.cast("long").alias("k1"), nothing.cast("long").alias("k2"))


def state(increment: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """What the checks need to know of an increment: one scan for all numbers, one shuffle per set of unique keys."""
    if any(c.args.get("group_by") or c.fail_calc for c in checks) or len({c.name for c in checks}) < len(checks):
        raise ValueError("checks by group or with numbers of their own have no state that merges; names must differ")
    plain = [c for c in checks if c.kind not in KEYS]
    parts = [increment.agg(F.array(*[_numbers(c) for c in plain]).alias("all")).select(F.inline("all"))] if plain else []
    for check in (c for c in checks if c.kind in KEYS):
        rows, columns = increment.filter(_kept(check)), [F.col(c) for c in _columns(check)]
        rows = rows.filter(columns[0].isNotNull()) if check.kind == "unique" else rows
        flags = [F.isnull(c) for c in columns]  # a hash passes over NULLs
        keyed = rows.select(F.xxhash64(*columns, *flags).alias("k1"), F.xxhash64(F.lit(1), *columns, *flags).alias("k2"))
        counted = keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).withColumn("check", F.lit(check.name))
        parts.append(counted.selectExpr("check", "n", "0L some", "cast(null as string) low", "cast(null as string) high",
                                        "cast(null as timestamp) moment", "k1", "k2"))
    return reduce(DataFrame.unionByName, parts)


def store_state(increment: DataFrame, checks: Sequence[Check], root: str, label: str) -> None:
    """Writes the state of the increment ``label``; only the increment is read."""
    write_version(state(increment, checks), f"{root}/{slugify_name(label)}")


def stored_state(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete state of every increment, in one scan."""
    fs, where = _file_system(spark, root)
    paths = []
    for entry in fs.listStatus(where):
        folder = f"{root}/{entry.getPath().getName()}"
        complete = [n for n, done in _versions(spark, folder) if done]
        if complete:
            paths.append(_version(folder, complete[-1]))
    return spark.read.schema(STATE).parquet(*sorted(paths)) if paths else spark.createDataFrame([], STATE)


def _failures(check: Check) -> Column:
    """The failure number, as an aggregate over the states of one check."""
    if check.kind in PREDICATES:
        return F.sum("n")
    if check.kind == "at_least_one":
        return (F.sum("some") == 0).cast("long")
    if check.kind == "not_null_proportion":
        share = F.sum("some") / F.nullif(F.sum("n"), F.lit(0))
        return (~share.between(check.args["at_least"], check.args.get("at_most", 1.0))).cast("long")
    if check.kind == "not_constant":
        return ((F.min("low") == F.max("low")) & (F.min("high") == F.max("high")) & (F.min("low") == F.max("high"))).cast("long")
    args = {k: v for k, v in check.args.items() if k not in ("group_by", "field")}
    newest, threshold = C.newest_and_threshold(F.col("moment"), **args)
    return (newest < threshold).cast("long")


def checked(spark: SparkSession, root: str, checks: Sequence[Check]) -> DataFrame:
    """check, failures and status over all stored increments.  Keys of one check meet by their digests alone."""
    states = stored_state(spark, root)
    number = F.lit(None).cast("long")
    for check in checks:
        if check.kind not in KEYS:
            number = F.when(F.col("check") == check.name, _failures(check)).otherwise(number)
    plain = states.filter(F.col("k1").isNull()).groupBy("check").agg(F.coalesce(number, F.lit(0)).alias("failures"))
    keys = states.filter(F.col("k1").isNotNull()).groupBy("check", "k1", "k2").agg(F.sum("n").alias("n"))
    keys = keys.filter(F.col("n") > 1).groupBy("check").agg(F.count(F.lit(1)).alias("failures"))
    names = spark.createDataFrame([(c.name,) for c in checks], "check string")
    found = names.join(plain.union(keys), "check", "left").select("check", F.coalesce("failures", F.lit(0)).alias("failures"))
    return found.withColumn("status", _status(checks))
