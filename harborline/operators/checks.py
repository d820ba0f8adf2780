"""Data-quality checks.  Each returns the failing rows; an empty result passes.

A row fails a predicate only where the predicate is false: NULL passes unless a check says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import eq, le, lt, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.dates import shift
from harborline.functions.numbers import safe_divide
from harborline.functions.text import slugify_name
from harborline.operators.joins import any_null, find_missing, one_sided_keys, side_by_side_counts
from harborline.operators.ordered import with_next, with_previous
from harborline.operators.setops import count_difference, symmetric_difference

# Predicates that are TRUE for a failing row; the suite counts many of them in one scan.


def fails_not_null(column: str) -> Column:
    return F.col(column).isNull()


def fails_range(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c, bad = F.col(column), []
    if min_value is not None:
        low = _column(min_value)
        bad.append(c < low if inclusive else c <= low)
    if max_value is not None:
        high = _column(max_value)
        bad.append(c > high if inclusive else c >= high)
    return reduce(or_, bad) if bad else F.lit(False)


def fails_expression(expression: str, column: str | None = None) -> Column:
    return ~F.expr(f"({expression})" if column is None else f"(`{column}` {expression})")


def fails_not_empty(column: str, trim_whitespace: bool = True) -> Column:
    return (F.trim(column) if trim_whitespace else F.col(column)) == ""


def fails_equal(actual: str, expected: str) -> Column:
    return F.col(actual) != F.col(expected)


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


# Checks on single rows.


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(fails_not_null(column))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds; a bound is a value or a column, and none at all passes."""
    return df.filter(fails_range(column, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows for which the SQL expression is false; with ``column`` the expression continues its name."""
    return df.filter(fails_expression(expression, column))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    return df.filter(fails_not_empty(column, trim_whitespace))


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.filter(fails_equal(actual, expected))


# Checks on values and groups.


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL does not count."""
    return unique_combination_of_columns(df.filter(F.col(column).isNotNull()), [column])


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their row count; NULLs are equal here."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list, with their row count."""
    outside = df.filter(~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """The forbidden values that occur."""
    return df.filter(F.col(column).isin(list(values))).select(F.col(column).alias("value_field")).distinct()


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) without one value that is not NULL.  An empty table fails, ungrouped."""
    if not group_by:
        df = df.select(column).filter(F.col(column).isNotNull()).limit(1)
    return df.groupBy(*group_by).agg(F.count(column).alias("n_values")).filter(F.col("n_values") == 0)


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) with exactly one distinct value; only NULLs is none, and passes."""
    ends = df.groupBy(*group_by).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    return ends.filter(F.col("__lo") == F.col("__hi")).select(*group_by, F.lit(1).cast("bigint").alias("n_distinct"))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) whose share of values that are not NULL is out of bounds."""
    share = safe_divide(F.count(column), F.count(F.lit(1)))
    shares = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    return shares.filter(~F.col("not_null_proportion").between(at_least, at_most))


def recency(df: DataFrame, field: str, part: str, interval: int, now: Column | None = None,
            ignore_time_component: bool = False, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) whose newest moment is more than ``interval`` parts before ``now``."""
    newest, threshold = newest_and_threshold(F.col(field), part, interval, now, ignore_time_component)
    return (df.groupBy(*group_by).agg(newest.alias("most_recent"))
            .withColumn("threshold", threshold)
            .filter(F.col("most_recent") < F.col("threshold")))


def newest_and_threshold(field: Column, part: str, interval: int, now: Column | None = None,
                         ignore_time_component: bool = False) -> tuple[Column, Column]:
    """The two moments that ``recency`` compares."""
    kind = "date" if ignore_time_component else "timestamp_ntz"
    return F.max(field).cast(kind), shift(F.current_timestamp() if now is None else now, part, -interval).cast(kind)


def columns_match_set(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Column names the table or the list has alone, in upper case; no data is read."""
    spark = df.sparkSession

    def listing(found: Iterable[str]) -> DataFrame:
        return spark.range(1).select(F.explode(F.array(*[F.lit(n.upper()) for n in found])).alias("column_name"))

    return one_sided_keys(listing(df.columns), listing(names), ["column_name"])


# Checks against another table.


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values, one per row, that ``to`` does not have; NULL passes."""
    return relationships_where(df, column, to, field)


def relationships_where(df: DataFrame, column: str, to: DataFrame, field: str,
                        from_condition: str | None = None, to_condition: str | None = None) -> DataFrame:
    """``relationships`` between the rows of both tables that meet a condition."""
    child = df.filter(from_condition) if from_condition else df
    parent = to.filter(to_condition) if to_condition else to
    ids = child.filter(F.col(column).isNotNull()).select(F.col(column).alias("id"))
    return find_missing(ids, parent, {"id": field}, spread_nulls=False)


def multi_column_relationship(df: DataFrame, to: DataFrame, from_columns: Sequence[str],
                              to_columns: Sequence[str]) -> DataFrame:
    """Distinct key tuples without NULLs that ``to`` does not have."""
    tuples = df.select(*from_columns).filter(~any_null(from_columns)).distinct()
    return find_missing(tuples, to, dict(zip(from_columns, to_columns, strict=True)), spread_nulls=False)


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose row counts differ between two columns."""
    return count_difference(df, column, to, field)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (),
                   strict: bool = False) -> DataFrame:
    """Row counts side by side with ``diff_count``; its sum is the failure number.

    A group on one side only has a NULL difference, which the sum leaves out; ``strict`` reads the
    missing side as zero rows.
    """
    counts = side_by_side_counts(df, compare, group_by)
    a, b = _counted(("count_a", "count_b"), strict)
    return counts.withColumn("diff_count", F.abs(a - b))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (),
                    strict: bool = False) -> DataFrame:
    """Row counts side by side with ``row_count_delta``: the surplus, 1 for equal counts, 0 for fewer rows."""
    names = ("count_our_model", "count_comparison_model")
    counts = side_by_side_counts(df, compare, group_by, names)
    ours, theirs = _counted(names, strict)
    surplus = ours - theirs
    delta = F.when(surplus > 0, surplus).when(surplus == 0, F.lit(1)).otherwise(F.lit(0))
    return counts.withColumn("row_count_delta", delta.cast("bigint"))


def _counted(names: Sequence[str], strict: bool) -> list[Column]:
    return [F.coalesce(F.col(n), F.lit(0)) if strict else F.col(n) for n in names]


def equality(df: DataFrame, compare: DataFrame, compare_columns: Sequence[str] | None = None,
             exclude_columns: Sequence[str] | None = None, precision: int | None = None) -> DataFrame:
    """Distinct rows of one table only, labelled ``which_diff``; numbers may be rounded first."""
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        listed = {c.lower() for c in compare_columns}
        columns = [c for c in df.columns if c.lower() in listed] if precision else list(compare_columns)
    else:
        skipped = {c.lower() for c in exclude_columns or ()}
        columns = [c for c in df.columns if c.lower() not in skipped]
        if {c.lower() for c in columns} != {c.lower() for c in compare.columns} - skipped:
            raise ValueError("the tables have different columns; name the ones to compare or to exclude")
    sides = [t.select([_rounded(t, c, precision) for c in columns]) for t in (df, compare)]
    return symmetric_difference(*sides)


def _rounded(df: DataFrame, name: str, precision: int | None) -> Column:
    kind = df.select(name).schema.fields[0].dataType
    if not precision or not isinstance(kind, (T.FractionalType, T.DecimalType)):
        return F.col(name).alias(name)
    number = F.col(name).try_cast("decimal(38,18)") if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(name)
    return F.round(number, precision).alias(name)


# Checks on neighbouring rows.

GAPS = {"not_allowed": eq, "allowed": le, "required": lt}


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str, partition_by: str | None = None,
                              gaps: str = "allowed", zero_length_range_allowed: bool = False) -> DataFrame:
    """Ranges that are empty, hold a NULL bound, or collide with the next range of their group.

    ``lower``, ``upper`` and ``partition_by`` are SQL expressions.
    """
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {list(GAPS)}, not {gaps!r}")
    group = ["partition_by_col"] if partition_by else []
    ranges = df.select(*[F.expr(partition_by).alias(g) for g in group],
                       F.expr(lower).alias("lower_bound"), F.expr(upper).alias("upper_bound"))
    ranges = with_next(ranges, ["lower_bound"], ["lower_bound", "upper_bound"], group, name="following")
    low, high = F.col("lower_bound"), F.col("upper_bound")
    last, after = F.col("following").isNull(), F.col("following.lower_bound")
    proper = low <= high if zero_length_range_allowed else low < high
    judged = ranges.select(
        *group, "lower_bound", "upper_bound", after.alias("next_lower_bound"), last.alias("is_last_record"),
        F.coalesce(proper, F.lit(False)).alias("range_is_proper"),
        F.coalesce(GAPS[gaps](high, after), last).alias("next_range_is_clear"))
    return judged.filter(~(F.col("range_is_proper") & F.col("next_range_is_clear")))


def sequential_values(df: DataFrame, column: str, interval: int = 1, part: str | None = None,
                      group_by: Sequence[str] = ()) -> DataFrame:
    """Rows whose value is not the one before plus ``interval`` (date parts); the first of a group passes."""
    before = f"previous_{slugify_name(column)}"
    rows = with_previous(df.select(*group_by, column), [column], [column], group_by, name="__found")
    rows = rows.withColumn(before, F.col(f"__found.`{column}`")).drop("__found")
    due = shift(F.col(before), part, interval) if part else F.col(before) + interval
    value = F.col(column).cast("timestamp_ntz") if part else F.col(column)
    return rows.filter(value != due)
