"""Column lists, constants, defaults and name clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.text import slugify_name


def columns_except(df: DataFrame, dropped: Iterable[str] = ()) -> list[str]:
    """Names of ``df`` without the given ones, matched without regard to case."""
    gone = {name.lower() for name in dropped}
    return [name for name in df.columns if name.lower() not in gone]


def star(df: DataFrame, dropped: Iterable[str] = (), prefix: str = "", suffix: str = "",
         relation_alias: str | None = None) -> list[Column]:
    """All columns but the given ones, renamed only where a prefix or suffix is asked for.

    ``relation_alias`` takes them from the table aliased so, after a join.
    """
    owner = f"{relation_alias}." if relation_alias else ""
    names = columns_except(df, dropped)
    plain = [F.col(f"{owner}`{c}`") for c in names]
    return [col.alias(f"{prefix}{c}{suffix}") for col, c in zip(plain, names)] if prefix or suffix else plain


def empty_to_null(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """The empty text becomes NULL in text columns (or in the named ones among them)."""
    wanted = None if names is None else {n.lower() for n in names}
    texts = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and (wanted is None or f.name.lower() in wanted)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts}) if texts else df


def with_constants(df: DataFrame, constants: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add constant columns given as name -> (value, type); a None value is a typed NULL."""
    return df.withColumns({c: F.lit(value).cast(kind) for c, (value, kind) in constants.items()})


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a value or column per name."""
    return df.withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v))
                           for c, v in defaults.items()})


def slugify_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its slug."""
    return df.toDF(*[slugify_name(c) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the columns of ``schema`` only, in its order and types; a column ``df`` lacks is NULL."""
    have = {f.name.lower(): f for f in df.schema.fields}

    def shaped(field: T.StructField) -> str:
        mine = have.get(field.name.lower())
        if mine is not None and mine.dataType == field.dataType:
            return f"`{mine.name}` as `{field.name}`"
        source = "null" if mine is None else f"`{mine.name}`"
        return f"cast({source} as {field.dataType.simpleString()}) as `{field.name}`"

    return df.selectExpr([shaped(f) for f in schema.fields])
