"""Run many checks and report one row per check.

Checks on single rows, and the ungrouped ones that are one aggregate or compare row counts, share one scan per table.
Every other check counts the rows it returns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.text import slugify_name
from harborline.operators import checks as C

CHECKS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f for f in (
        C.not_null, C.unique, C.relationships, C.accepted_values, C.multi_column_relationship, C.accepted_range,
        C.at_least_one, C.cardinality_equality, C.equal_rowcount, C.equality, C.expression_is_true,
        C.fewer_rows_than, C.mutually_exclusive_ranges, C.not_accepted_values, C.not_constant, C.not_empty_string,
        C.not_null_proportion, C.recency, C.relationships_where, C.sequential_values,
        C.unique_combination_of_columns, C.columns_match_set, C.assert_equal)
}

PREDICATES: dict[str, Callable[..., Column]] = {
    "not_null": C.fails_not_null, "accepted_range": C.fails_range, "expression_is_true": C.fails_expression,
    "not_empty_string": C.fails_not_empty, "assert_equal": C.fails_equal,
}

# Failure numbers that are not the row count, over the failing rows.
FAIL_CALC: dict[str, str] = {
    "equal_rowcount": "coalesce(sum(diff_count), 0)",
    "fewer_rows_than": "coalesce(sum(row_count_delta), 0)",
    "equality": "count(*) + coalesce(abs(sum(if(which_diff = 'a_minus_b', 1, -1))), 0)",
}

THRESHOLD = re.compile(r"\s*(=|==|!=|<>|<|<=|>|>=)\s*[0-9]+\s*")


@dataclass(frozen=True)
class Check:
    """One check of one table.

    ``args`` go to the check function; an argument named ``to`` or ``compare`` may be a table name.
    ``error_if`` and ``warn_if`` compare the failure number, e.g. ``"> 10"``.
    """

    name: str
    table: str
    kind: str
    args: Mapping = field(default_factory=dict)
    where: str | None = None
    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    fail_calc: str | None = None

    def __post_init__(self):
        if self.kind not in CHECKS:
            raise ValueError(f"unknown check {self.kind!r}")
        if self.severity not in ("error", "warn"):
            raise ValueError("severity must be 'error' or 'warn'")
        for threshold in (self.error_if, self.warn_if):
            if not THRESHOLD.fullmatch(threshold):
                raise ValueError(f"not a threshold: {threshold!r}")


def register_check(name: str, function: Callable[..., DataFrame], fail_calc: str | None = None) -> None:
    """Make a check of one's own known to the suite."""
    CHECKS[name] = function
    if fail_calc:
        FAIL_CALC[name] = fail_calc


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows that fail one check."""
    args = {k: tables[v] if k in ("to", "compare") and isinstance(v, str) else v for k, v in check.args.items()}
    df = tables[check.table]
    return CHECKS[check.kind](df.filter(check.where) if check.where else df, **args)


def _calc(check: Check) -> str | None:
    return check.fail_calc or FAIL_CALC.get(check.kind)


def _fusable(check: Check) -> Column | None:
    """The failure number as one aggregate over the whole table, where the check is of that sort."""
    if check.fail_calc or check.args.get("group_by"):
        return None
    keep = _kept(check)
    if check.kind in PREDICATES:
        return F.count_if(keep & PREDICATES[check.kind](**check.args))
    value = F.when(keep, F.col(check.args["column"])) if "column" in check.args else None
    if check.kind == "at_least_one":
        return F.when(F.count(value) == 0, F.lit(1)).otherwise(F.lit(0))
    if check.kind == "not_constant":
        return F.when(F.min(value) == F.max(value), F.lit(1)).otherwise(F.lit(0))
    if check.kind == "not_null_proportion":
        share = F.count(value) / F.nullif(F.count_if(keep), F.lit(0))
        return F.when(~share.between(check.args["at_least"], check.args.get("at_most", 1.0)), F.lit(1)).otherwise(F.lit(0))
    if check.kind == "recency":
        args = {k: v for k, v in check.args.items() if k != "group_by"}
        newest, threshold = C.newest_and_threshold(F.when(keep, F.col(args.pop("field"))), **args)
        return F.when(newest < threshold, F.lit(1)).otherwise(F.lit(0))
    return None


def _kept(check: Check) -> Column:
    return F.expr(check.where) if check.where else F.lit(True)


def _two_counts(check: Check) -> bool:
    """Whether the check needs nothing but the row counts of two named tables."""
    return (check.kind in ("equal_rowcount", "fewer_rows_than") and not check.fail_calc
            and not check.args.get("group_by") and isinstance(check.args.get("compare"), str))


def _difference(check: Check) -> Column:
    """The failure number of a check of two counts, from the sums ``ours`` and ``theirs``; no rows are NULL rows unless strict."""
    empty = F.lit(-1 if check.args.get("strict") else 0)
    surplus = F.nullif("ours", empty) - F.nullif("theirs", empty)
    if check.kind == "equal_rowcount":
        return F.coalesce(F.abs(surplus), F.lit(0))
    return F.when(surplus > 0, surplus).when(surplus == 0, F.lit(1)).otherwise(F.lit(0))


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check], store: str | None = None) -> DataFrame:
    """One row per check: ``check``, ``failures`` and ``status`` ('pass', 'warn' or 'error').

    All numbers that are aggregates of a whole table, row counts included, come from one scan of it.  With ``store``
    the failing rows of every check are written under that folder instead, and counted from there, so a check is
    evaluated once (by jobs that run at once).
    """
    names = [c.name for c in checks]
    if len(set(names)) < len(names):
        raise ValueError("check names must differ")
    if store is not None:
        return _stored_results(tables, checks, store_failures(tables, checks, store))
    fused: dict[str, list[tuple[str, str, Column]]] = {}
    counted = []
    for check in checks:
        number = _fusable(check)
        if number is not None:
            fused.setdefault(check.table, []).append((check.name, "failures", number))
        elif _two_counts(check):
            fused.setdefault(check.table, []).append((check.name, "ours", F.count_if(_kept(check))))
            fused.setdefault(check.args["compare"], []).append((check.name, "theirs", F.count(F.lit(1))))
        else:
            counted.append(_count(check, failing_rows(check, tables)))
    pairs = [c for c in checks if _two_counts(c)]
    parts = []
    for table, numbers in fused.items():
        found = [F.struct(F.lit(name).alias("check"), F.lit(part).alias("part"), n.cast("bigint").alias("n"))
                 for name, part, n in numbers]
        parts.append(tables[table].agg(F.array(*found).alias("found")).select(F.inline("found")))
    if parts:
        sides = [F.sum(F.when(F.col("part") == side, F.col("n"))).alias(side) for side in ("failures", "ours", "theirs")]
        sums = reduce(DataFrame.union, parts).groupBy("check").agg(*sides)
        number = F.col("failures")
        for check in pairs:
            number = F.when(F.col("check") == check.name, _difference(check)).otherwise(number)
        counted.append(sums.select("check", number.cast("bigint").alias("failures")))
    return reduce(DataFrame.union, counted).withColumn("status", _status(checks))


def _count(check: Check, rows: DataFrame) -> DataFrame:
    total = F.expr(_calc(check) or "count(*)").cast("bigint").alias("failures")
    return rows.agg(total).select(F.lit(check.name).alias("check"), "failures")


def _stored_results(tables: Mapping[str, DataFrame], checks: Sequence[Check], paths: Mapping[str, str]) -> DataFrame:
    read = next(iter(tables.values())).sparkSession.read
    counted = [_count(c, read.parquet(paths[c.name])) for c in checks]
    return reduce(DataFrame.union, counted).withColumn("status", _status(checks))


def _status(checks: Sequence[Check]) -> Column:
    error = warn = F.lit(False)
    for c in checks:
        mine = F.col("check") == c.name
        if c.severity == "error":
            error = error | (mine & F.expr(f"failures {c.error_if}"))
        warn = warn | (mine & F.expr(f"failures {c.warn_if}"))
    return F.when(error, F.lit("error")).when(warn, F.lit("warn")).otherwise(F.lit("pass"))


def store_failures(tables: Mapping[str, DataFrame], checks: Sequence[Check], root: str) -> dict[str, str]:
    """Write the failing rows of every check as a table under ``root``, in a folder named by the check's slug.

    Returns check -> path.
    """
    paths = {c.name: f"{root}/{slugify_name(c.name)}" for c in checks}
    if len({p.lower() for p in paths.values()}) < len(checks):
        raise ValueError("the names of the checks must differ as folders too")
    for check in checks:
        failing_rows(check, tables).write.mode("overwrite").parquet(paths[check.name])
    return paths
