"""Grouping by position, value lists, pivot, unpivot and one best row per key."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from operator import eq, ge, gt, le, lt, ne

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.text import ci_key, slugify_name
from harborline.operators.project import columns_except
from harborline.session import staged

COMPARE: dict[str, Callable] = {
    "=": eq, "<>": ne, "!=": ne, "<": lt, "<=": le, ">": gt, ">=": ge,
    "like": lambda c, p: c.like(p), "ilike": lambda c, p: c.ilike(p),
}
AGGREGATES: dict[str, Callable] = {
    "sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg,
}
DISTINCT_AGGREGATES: dict[str, Callable] = {**AGGREGATES, "sum": F.sum_distinct, "count": F.count_distinct}


def group_by_first(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


def column_values(df: DataFrame, column: str, where: str | Column | None = None,
                  order_by: Sequence[Column] | None = None, max_records: int | None = None) -> DataFrame:
    """Distinct values (NULL is one) as column ``value``, most frequent first unless told otherwise.

    ``order_by`` may use ``value`` and ``n``, the number of rows.
    """
    rows = df if where is None else df.filter(where)
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = list(order_by) if order_by is not None else [F.desc("n")]
    ranked = counted.orderBy(*order, F.asc_nulls_first("value"))
    return (ranked if max_records is None else ranked.limit(max_records)).select("value")


def top_values(df: DataFrame, column: str, k: int, cells: int = 1 << 16) -> DataFrame:
    """The ``k`` most frequent values (NULL is one) as ``value`` and ``n``, exact; ties go to the smaller value.

    For a column with very many values: rows are first counted by ``cells`` cells of their hash.  The values of the ``k``
    fullest cells are counted, and the k-th of their counts bounds the k-th of all from below; a cell that holds fewer rows
    holds no value of the result, so only values of the other cells are counted.  Writes the counts of the cells.
    """
    rows = df.select(F.col(f"`{column}`").alias("value"))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("value"), F.lit(cells)))
    held = staged(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")), "cells")

    def counted(some: DataFrame) -> DataFrame:
        return rows.join(some.select("cell"), "cell", "left_semi").groupBy("value").agg(F.count(F.lit(1)).alias("n"))

    fullest = counted(held.orderBy(F.desc("rows"), "cell").limit(k))
    found = [r["n"] for r in fullest.orderBy(F.desc("n")).limit(k).select("n").collect()]
    least = found[-1] if len(found) == k else 0
    return counted(held.filter(F.col("rows") >= least)).orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(k)


def value_list(df: DataFrame, column: str, max_values: int = 1000, default: list | None = None, **kwargs) -> list:
    """``column_values`` on the driver, to name pivot columns; fails beyond ``max_values``."""
    found = [r.value for r in column_values(df, column, **kwargs).take(max_values + 1)]
    if len(found) > max_values:
        raise ValueError(f"column {column} has more than {max_values} values")
    return found or (default if default is not None else [])


def pivot_columns(column: str, values: Iterable, alias: bool = True, agg: str = "sum", cmp: str = "=",
                  prefix: str = "", suffix: str = "", then_value=1, else_value=0, quote_identifiers: bool = True,
                  distinct: bool = False) -> list[Column]:
    """One aggregate per value over ``then_value`` where the comparison holds, else ``else_value``.

    The name is the value between prefix and suffix, its slug without ``quote_identifiers``, or left to Spark
    without ``alias``.
    """
    compare = COMPARE[cmp.lower()]
    combine = (DISTINCT_AGGREGATES if distinct else AGGREGATES)[agg.lower()]
    then, other = (v if isinstance(v, Column) else F.lit(v) for v in (then_value, else_value))

    def one(value) -> Column:
        name = f"{prefix}{value}{suffix}"
        cell = F.when(compare(F.col(column), F.lit(value)), then).otherwise(other)
        if not alias:
            return combine(cell)
        return combine(cell).alias(name if quote_identifiers else slugify_name(name))

    return [one(v) for v in values]


def pivot(df: DataFrame, group_by: Sequence[str], column: str, values: Iterable, **kwargs) -> DataFrame:
    """Rows to columns: one output column per value, cells without rows hold the else value."""
    return df.groupBy(*group_by).agg(*pivot_columns(column, values, **kwargs))


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Iterable[str] = (), remove: Iterable[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """Columns to rows in one scan: the kept columns, the column name and its value in one type."""
    kept_lower = {c.lower() for c in exclude}
    kept = [c for c in df.columns if c.lower() in kept_lower]
    folded = columns_except(df, [*exclude, *remove])
    if not folded:
        raise ValueError("no column is left to unpivot")
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def as_value(name: str) -> Column:
        col = F.col(f"`{name}`")
        return (col.cast("string") if isinstance(kinds[name], T.BooleanType) else col).cast(cast_to).alias(name)

    cast = df.select(*[F.col(f"`{c}`") for c in kept], *map(as_value, folded))
    return cast.unpivot(kept, folded, field_name, value_name)


def best_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; equal rows are told apart by a row hash.

    Every task keeps one row per key before the shuffle (the plan shows a partial group limit), so a hot
    key costs one row per task.
    """
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    window = Window.partitionBy(*keys).orderBy(*order_by, F.xxhash64(*hashed))
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") == 1).drop("__rn")


def distinct_ci(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Distinct texts under the case-insensitive comparison; the smallest spelling stands for each."""
    return (df.groupBy(ci_key(F.col(column)).alias("__key"))
            .agg(F.min(column).alias(name or column)).drop("__key"))
