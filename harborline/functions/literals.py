"""Driver-side values as typed constants of a plan, never as SQL text."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def constant_text(value) -> str | None:
    """``value`` as the text that a cast to its type reads."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, float):
        return repr(value).replace("inf", "Infinity").replace("nan", "NaN")
    if isinstance(value, Decimal):
        return format(value, "f")
    return str(value)


def constant_rows(rows: Sequence[Sequence], names: Sequence[str]) -> Column:
    """Plain values as an array of structs, one string literal whatever the values hold; NULL stays NULL.

    Each column takes the one SQL type that its values have in common.
    """
    kinds = [common_kind(column) for column in zip(*rows)]
    text = json.dumps([dict(zip(names, map(constant_text, row))) for row in rows])
    fields = ", ".join(f"`{name}`: string" for name in names)
    read = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    return F.transform(read, lambda r: F.struct(*[r.getField(n).cast(kind).alias(n) for n, kind in zip(names, kinds)]))


# The first that fits counts: a truth value is also a number, a moment also a date.
KINDS = [(bool, "boolean"), (int, "bigint"), (float, "double"), (Decimal, "decimal(38,18)"), (str, "string"),
         (dt.datetime, "timestamp_ntz"), (dt.date, "date")]


def common_kind(values: Iterable) -> str:
    """The one SQL type of some plain values, NULL aside."""
    found = {next((kind for sort, kind in KINDS if isinstance(v, sort)), None) for v in values if v is not None}
    if len(found) != 1 or None in found:
        raise TypeError("the values need one plain type in common")
    return found.pop()
