"""Unions of tables with different columns, and set differences in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.session import staged


def union_relations(tables: Mapping[str, DataFrame], column_override: Mapping[str, str] | None = None,
                    include: Iterable[str] = (), exclude: Iterable[str] = (),
                    source_column_name: str | None = "source_relation",
                    where: str | Column | None = None) -> DataFrame:
    """UNION ALL of named tables over all their columns, in first-seen order and type.

    A column a table lacks is NULL there.  ``include`` and ``exclude`` ignore case; names of two tables
    are the same column only if spelled alike.  Everything is cast, so Spark never widens a type itself.
    """
    included, excluded = ({c.lower() for c in names} for names in (include, exclude))
    if included and excluded:
        raise ValueError("give include or exclude, not both")

    def wanted(name: str) -> bool:
        return name.lower() not in excluded and (not included or name.lower() in included)

    kinds: dict[str, T.DataType | str] = {}
    for table in tables.values():
        for field in table.schema.fields:
            if wanted(field.name):
                kinds.setdefault(field.name, field.dataType)
    if not kinds:
        raise ValueError("no column is left to union")
    kinds.update({c: t for c, t in (column_override or {}).items() if c in kinds})

    def shaped(label: str, table: DataFrame) -> DataFrame:
        rows = table if where is None else table.filter(where)
        tag = [] if source_column_name is None else [F.lit(label).alias(source_column_name)]
        return rows.select(*tag, *[(F.col(f"`{c}`") if c in table.columns else F.lit(None)).cast(t).alias(c)
                                   for c, t in kinds.items()])

    return reduce(DataFrame.union, [shaped(label, table) for label, table in tables.items()])


def _tagged(a: DataFrame, b: DataFrame) -> DataFrame:
    mark = [(F.lit(x).alias("__a"), F.lit(1 - x).alias("__b")) for x in (1, 0)]
    return a.select("*", *mark[0]).union(b.select("*", *mark[1]))


def symmetric_difference(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of one side only, labelled ``which_diff`` 'a_minus_b' or 'b_minus_a'; NULL equals NULL.

    One pre-aggregated shuffle over both tables replaces two anti joins.
    """
    columns = list(columns or a.columns)
    label = F.when(F.col("__a") == 1, F.lit("a_minus_b")).otherwise(F.lit("b_minus_a"))
    return (_tagged(a.select(*columns), b.select(*columns)).groupBy(*columns)
            .agg(F.max("__a").alias("__a"), F.max("__b").alias("__b"))
            .filter(F.col("__a") != F.col("__b"))
            .select(label.alias("which_diff"), *columns))


def difference_by_checksum(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None,
                           fanout: int = 4096) -> DataFrame:
    """As ``symmetric_difference``, for tables that should be equal: only rows of unequal parts move.

    Rows fall into ``fanout`` parts by a hash of all columns, and each part into as many again.  A part has a checksum
    that does not depend on the order of its rows: their number and three sums of two further hashes.  Parts are summed
    where the rows are, those of ``b`` with the other sign: one sum for both tables, zero where they are equal.  Parts that
    differ are split once more, and the rows of the unequal small parts are compared one by one; equal tables are read once
    and nothing but checksums moves.  Repeated rows make a part unequal at most.
    Writes the unequal parts, by jobs that run at once.
    """
    columns = list(columns or a.columns)
    known = [F.isnull(F.col(f"`{c}`")) for c in columns]  # a hash passes over NULLs
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in columns], *known)
    second = F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in columns], *known)
    part, small = F.pmod(hashed, F.lit(fanout)), F.pmod(F.shiftright(hashed, 32), F.lit(fanout))
    sides = [t.select(*[F.col(f"`{c}`") for c in columns], part.alias("__part"), (part * fanout + small).alias("__small"),
                      second.alias("__sum")) for t in (a, b)]

    def unequal(tables: Sequence[DataFrame], part: str, label: str) -> DataFrame:
        low, high = F.col("__sum").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("__sum", 32)
        signed = [t.select(part, F.lit(sign).alias("n"), (low * sign).alias("x"), (high * sign).alias("y"), F.col("__sum").alias("z"))
                  for t, sign in zip(tables, (1, -1), strict=True)]
        summed = reduce(DataFrame.union, signed).groupBy(part).agg(
            F.sum("n").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"), F.bit_xor("z").alias("z"))
        return staged(summed.filter("n <> 0 or x <> 0 or y <> 0 or z <> 0").select(part), label)

    for part in ("__part", "__small"):
        differ = unequal(sides, part, "unequal-parts")
        if differ.isEmpty():
            return symmetric_difference(a.select(*columns).limit(0), b.select(*columns).limit(0), columns)
        sides = [t.join(differ, part, "left_semi") for t in sides]
    return symmetric_difference(*[t.select(*[F.col(f"`{c}`") for c in columns]) for t in sides], columns)


def count_difference(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """Values whose row counts differ, one row ``(column, num_rows)`` per side that holds the value."""
    counts = (_tagged(a.select(F.col(column)), b.select(F.col(field)))
              .groupBy(column).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
              .filter(F.col("__a") != F.col("__b")))
    return (counts.select(column, F.explode(F.array("__a", "__b")).alias("num_rows"))
            .filter(F.col("num_rows") > 0))
