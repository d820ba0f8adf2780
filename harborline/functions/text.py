"""Text recodes, flags, substrings, addresses and name clean-up."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ci_key(col: Column) -> Column:
    """Comparison key of a case-insensitive, accent-sensitive text column; trailing blanks do not count."""
    return F.lower(F.rtrim(col))


def same_text(col: Column, value: str) -> Column:
    """``col = value`` under the case-insensitive comparison."""
    return ci_key(col) == F.lit(value.rstrip(" ").lower())


def matches(col: Column, pattern: str) -> Column:
    """One recode arm: a pattern with ``%`` is a case-insensitive LIKE, any other one an equality."""
    return col.ilike(pattern) if "%" in pattern else same_text(col, pattern)


def recode(col: Column, arms: Sequence[tuple[str, object]], default=None) -> Column:
    """Value of the first arm ``(pattern, value)`` that matches, else ``default``."""
    chain = None
    for pattern, value in arms:
        hit = matches(col, pattern)
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def flag_when(col: Column, word: str) -> Column:
    """1 where the text is ``word``, else 0 (NULL counts as 0)."""
    return F.when(same_text(col, word), F.lit(1)).otherwise(F.lit(0))


def flag_unless(col: Column, word: str) -> Column:
    """0 where the text is ``word``, else 1 (NULL counts as 1)."""
    return F.when(same_text(col, word), F.lit(0)).otherwise(F.lit(1))


def fixed_width(col: Column, width: int) -> Column:
    """Text cut to ``width`` characters, as a cast to a bounded text type does."""
    return F.left(col.cast("string"), F.lit(width))


def storage_number(label: Column, sites: Iterable[str], kinds: Iterable[str]) -> Column:
    """Number in a storage label such as ``RB SHELF 12``; NULL where the label names no storage."""
    pattern = f"(?i)(?:{'|'.join(sites)}) (?:{'|'.join(kinds)}) *([0-9]+)"
    return F.regexp_extract(label, pattern, 1).try_cast("decimal(18,0)")


def storage_kind(label: Column, kinds: Iterable[str]) -> Column:
    """The first storage kind the label contains, else NULL."""
    return recode(label, [(f"%{kind}%", kind) for kind in kinds])


def join_text(*cols: Column) -> Column:
    """Concatenation that reads NULL as the empty text."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def address(first: Column, *more: Column) -> Column:
    """Address line: each later part present is put after one blank, even where the first is missing."""
    return join_text(first, *[F.concat(F.lit(" "), c) for c in more])


def upper_trim(col: Column) -> Column:
    """Upper case without white space at the ends."""
    return F.upper(F.regexp_replace(col, r"^\s+|\s+$", ""))


def int_or(col: Column, default: int) -> Column:
    """Whole number in the text, or ``default`` where there is none."""
    return F.coalesce(col.try_cast("int"), F.lit(default))


def slugify(col: Column) -> Column:
    """Lower-case name of letters, digits and underscores that does not start with a digit."""
    joined = F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), "[ -]+", "_")
    plain = F.regexp_replace(joined, "[^a-z0-9_]+", "")
    return F.regexp_replace(plain, "^([0-9])", "_$1")


def slugify_name(name: str | None) -> str:
    """The same clean-up for one column name."""
    plain = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", (name or "").lower()))
    return f"_{plain}" if plain[:1].isdigit() else plain


def collated(c: Column, collation: str = "UNICODE_CI_RTRIM") -> Column:
    """Text that compares, joins and groups without case and trailing blanks, and keeps its spelling."""
    return F.collate(c, collation)
