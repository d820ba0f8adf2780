"""Existence joins, lookups and comparisons of two tables.

Join sides carry no broadcast hint except literal maps, whose size is known when the plan is built; for
DataFrames Spark compares the side with its own broadcast limit and otherwise shuffles, where
adaptive execution splits a hot key of the larger side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.literals import constant_rows
from harborline.functions.text import ci_key

MAX_LITERAL_MAP = 10_000

Keys = Sequence[str] | Mapping[str, str]


def key_pairs(on: Keys) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]


def any_null(names: Iterable[str]) -> Column:
    return reduce(or_, [F.col(n).isNull() for n in names])


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """An extra join key that equal keys share and that spreads rows with a NULL key over all tasks.

    NULL keys match nothing, yet a hash join sends all of them to one task.  Their hash is taken
    over the whole row instead.
    """
    row = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.when(any_null(keys), F.xxhash64(*row)).otherwise(F.xxhash64(*keys))


def _keyed(df: DataFrame, other: DataFrame, on: Keys, ci: bool) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """Both sides with comparable key columns, and their names; the right side has nothing else.

    A left key that needs no change stays the column it is, so that two joins on it share one shuffle.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    lefts, rights, added, chosen = [], [], {}, []
    for i, (l, r) in enumerate(key_pairs(on)):
        kind = types[l.lower()]
        right = F.col(r).cast(kind)
        if ci and isinstance(kind, T.StringType):
            added[f"__l{i}"], right = ci_key(F.col(l)), ci_key(right)
        lefts.append(f"__l{i}" if f"__l{i}" in added else l)
        rights.append(f"__r{i}")
        chosen.append(right.alias(f"__r{i}"))
    return df.withColumns(added) if added else df, other.select(chosen), lefts, rights


def _added(names: Iterable[str]) -> list[str]:
    return [n for n in names if n.startswith("__l")]


def keep_known(df: DataFrame, known: DataFrame, on: Keys, null_safe: bool = False, ci: bool = False) -> DataFrame:
    """Rows whose key occurs in ``known``; NULL equals nothing unless ``null_safe``."""
    left, right, lefts, rights = _keyed(df, known, on, ci)
    match = reduce(and_, [F.col(l).eqNullSafe(F.col(r)) if null_safe else F.col(l) == F.col(r)
                          for l, r in zip(lefts, rights)])
    return left.join(right, match, "left_semi").drop(*_added(lefts))


def find_missing(df: DataFrame, other: DataFrame, on: Keys, null_safe: bool = False, ci: bool = False,
                 spread_nulls: bool = True) -> DataFrame:
    """Rows whose key does not occur in ``other``.

    A NULL key matches nothing and stays, unless ``null_safe`` lets NULL equal NULL.  ``spread_nulls=False``
    saves the hash that spreads such rows where the caller knows that there are none.
    """
    left, right, lefts, rights = _keyed(df, other, on, ci)
    if null_safe:
        match = reduce(and_, [F.col(l).eqNullSafe(F.col(r)) for l, r in zip(lefts, rights)])
        return left.join(right, match, "left_anti").drop(*_added(lefts))
    if spread_nulls:
        left = left.withColumn("__lh", key_hash(left, lefts))
        right = right.withColumn("__rh", F.xxhash64(*rights))
        lefts, rights = [*lefts, "__lh"], [*rights, "__rh"]
    match = reduce(and_, [F.col(l) == F.col(r) for l, r in zip(lefts, rights)])
    return left.join(right, match, "left_anti").drop(*_added(lefts))


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """``column NOT IN (other)`` with SQL's NULL rules, as a distributed join.

    One NULL in ``other`` leaves no row; an empty ``other`` leaves all; otherwise NULL values drop.
    """
    n, known = F.count(F.lit(1)), F.count(other_column)
    sort = F.when(n == 0, F.lit("empty")).when(n > known, F.lit("null")).otherwise(F.lit("plain"))
    listed = other.agg(sort.alias("sort")).scalar()
    rows = df.filter((listed == "empty") | ((listed == "plain") & F.col(column).isNotNull()))
    return find_missing(rows, other, {column: other_column}, spread_nulls=False)


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all columns the two tables share; rows with a NULL in one of them drop out."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return left.join(right, shared)


def require_unique(df: DataFrame, keys: Sequence[str], ci: bool = False) -> DataFrame:
    """``df`` unchanged; the job that reads it fails if a key without NULLs occurs twice.

    The count of repeated keys is a scalar subquery beside the rows, so a join of the result still reads
    a plain shuffle, which adaptive execution can split where a key is hot.
    """
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)} if ci else ()
    plain = df.select([ci_key(F.col(k)).alias(k) if k in texts else F.col(k) for k in keys])
    repeated = (plain.filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > 1).agg(F.count(F.lit(1)).alias("n")).scalar())
    clash = F.raise_error(F.concat(F.lit("keys that must be unique and are not: "), repeated.cast("string")))
    return df.filter(F.when(repeated == 0, F.lit(True)).otherwise(clash.cast("boolean")))


def decode(df: DataFrame, column: str, mapping: Mapping | DataFrame, name: str,
           key: str = "code", value: str = "id", ci: bool = False) -> DataFrame:
    """Add ``name``: the value the mapping gives for ``column``, NULL where it has none.

    The mapping is a literal dict (broadcast: its size is known here) or a DataFrame with unique keys.
    """
    if isinstance(mapping, Mapping):
        if len(mapping) > MAX_LITERAL_MAP:
            raise ValueError(f"give a mapping of more than {MAX_LITERAL_MAP} entries as a DataFrame")
        rows = [(ci_text(k) if ci else k, v) for k, v in mapping.items()]
        if not rows or len({k for k, _ in rows}) < len(rows):
            raise ValueError("the lookup needs entries, and its keys must be unique")
        lookup = F.broadcast(_literal_table(df.sparkSession, rows))
    else:
        code = ci_key(F.col(key)) if ci else F.col(key)
        keyed = mapping.select(code.alias("__code"), F.col(value).alias("__value"))
        lookup = require_unique(keyed.filter(F.col("__code").isNotNull()), ["__code"])
    code = ci_key(F.col(column)) if ci else F.col(column)
    joined = df.join(lookup, code == F.col("__code"), "left")
    return joined.select(*[c for c in df.columns if c != name], F.col("__value").alias(name))


def _literal_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """A map as a constant of the plan; whole numbers are 64-bit."""
    return spark.range(1).select(F.inline(constant_rows(rows, ["__code", "__value"])))


def ci_text(text: str) -> str:
    """Driver-side twin of ``ci_key``."""
    return text.rstrip(" ").lower()


def single_value(df: DataFrame, default=None) -> Column:
    """First column of the first row as a scalar for use in any expression; ``default`` if there is no row."""
    first = df.select(F.col(df.columns[0]).alias("v")).limit(1)
    found = F.when(F.count(F.lit(1)) == 0, F.lit(default)).otherwise(F.first("v"))
    return first.agg(found.alias("v")).scalar()


def side_by_side_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str] = (),
                        names: tuple[str, str] = ("count_a", "count_b")) -> DataFrame:
    """Row counts of two tables per group, matched as a full join does: NULL groups stay apart.

    Both tables go through one pre-aggregated shuffle; no join is needed.
    """
    cols = list(group_by)
    sides = [t.select(*cols, F.lit(s).alias("__side")) for s, t in enumerate((a, b))]
    apart = F.when(any_null(cols), F.col("__side")).otherwise(F.lit(-1)) if cols else F.lit(-1)
    counts = (sides[0].unionByName(sides[1]).withColumn("__apart", apart)
              .groupBy(*cols, "__apart")
              .agg(*[F.sum(F.when(F.col("__side") == s, F.lit(1))).alias(n) for s, n in enumerate(names)]))
    shown = []
    for c in cols:
        shown += [F.when(F.col(names[0]).isNotNull(), F.col(c)).alias(f"{c}_a"),
                  F.when(F.col(names[1]).isNotNull(), F.col(c)).alias(f"{c}_b")]
    return counts.select(*shown, *names)


def one_sided_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys found in one table only, with ``side`` 'a' or 'b'."""
    tagged = [t.select(*keys, F.lit(s).alias("__side")) for s, t in (("a", a), ("b", b))]
    return (tagged[0].unionByName(tagged[1]).groupBy(*keys)
            .agg(F.min("__side").alias("side"), F.max("__side").alias("__last"))
            .filter(F.col("side") == F.col("__last")).drop("__last"))
