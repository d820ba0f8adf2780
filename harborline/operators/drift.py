"""Schemas that change from load to load.

``evolve`` gives the schema of a table once a source with other columns has come: unchanged (``ignore``), with the new
columns and the wider types (``add``), or not at all (``refuse``).  A type is widened only where every stored value keeps
its meaning and Spark reads the old files as the wider type: no file is written anew for a change.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

POLICIES = ("ignore", "add", "refuse")
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}  # digits, as Spark's own widening counts them
_RANK = list(_WHOLE)


class SchemaChange(ValueError):
    """A source whose columns a table does not take."""


def _decimal(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (_WHOLE[type(kind)], 0) if type(kind) in _WHOLE else None


def wider(mine: T.DataType, theirs: T.DataType) -> T.DataType | None:
    """The type that holds all values of both; None where there is none that stored files can be read as."""
    if mine.simpleString() == theirs.simpleString():
        return mine
    a, b = type(mine), type(theirs)
    if a in _WHOLE and b in _WHOLE:
        return max(mine, theirs, key=lambda t: _RANK.index(type(t)))
    if T.DecimalType in (a, b):
        x, y = _decimal(mine), _decimal(theirs)
        if x is None or y is None:
            return None
        digits, scale = max(x[0], y[0]), max(x[1], y[1])
        if digits + scale > 38:
            return None
        return T.DecimalType(digits + scale, scale)
    doubles = (T.DoubleType, T.FloatType, T.ByteType, T.ShortType, T.IntegerType)  # each exact in a double
    if T.DoubleType in (a, b) and a in doubles and b in doubles:
        return T.DoubleType()
    if {a, b} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def evolve(schema: T.StructType, source: T.StructType, on_change: str = "ignore", fixed: Iterable[str] = ()) -> T.StructType:
    """The schema of a table after a load; the table's names and order stay, new columns come last.

    A column that the source lacks, or has in a narrower type, is no change.  The ``fixed`` columns, the keys, keep
    their types: their stored ranges and hashes depend on them.
    """
    if on_change not in POLICIES:
        raise ValueError(f"on_change must be one of {', '.join(POLICIES)}")
    if on_change == "ignore":
        return schema
    fixed, comes = {c.lower() for c in fixed}, {f.name.lower(): f for f in source.fields}
    have = {f.name.lower() for f in schema.fields}
    fields, faults = [], []
    for field in schema.fields:
        theirs = comes.get(field.name.lower())
        kind = field.dataType if theirs is None or isinstance(theirs.dataType, T.NullType) else wider(field.dataType, theirs.dataType)
        if kind is None or (kind != field.dataType and (field.name.lower() in fixed or on_change == "refuse")):
            faults.append(f"{field.name} {field.dataType.simpleString()} against {theirs.dataType.simpleString()}")
        fields.append(T.StructField(field.name, kind or field.dataType, True))
    for name, field in comes.items():
        if name not in have:
            if on_change == "refuse" or isinstance(field.dataType, T.NullType):
                faults.append(f"{field.name} {field.dataType.simpleString()} is new")
            fields.append(T.StructField(field.name, field.dataType, True))
    if faults:
        raise SchemaChange("the table does not take these columns: " + "; ".join(faults))
    return T.StructType(fields)
