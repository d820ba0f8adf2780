"""Host, path and query parameter of URL text, by plain string cutting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _without(col: Column, *prefixes: str) -> Column:
    for prefix in prefixes:
        col = F.replace(col, F.lit(prefix), F.lit(""))
    return col


def _before(col: Column, mark: str) -> Column:
    return F.split_part(col, F.lit(mark), F.lit(1))


def url_host(url: Column) -> Column:
    """Text between the scheme and the first ``/`` or ``?``; a port or fragment stays."""
    bare = _without(url, "android-app://", "http://", "https://")
    return _before(_before(bare, "/"), "?")


def url_path(url: Column) -> Column:
    """Text after the first ``/`` and before ``?``, without the leading slash.

    With a ``?`` and no ``/`` the path is empty; with neither the whole text comes back.
    """
    bare = _without(url, "http://", "https://")
    slash = F.locate("/", bare)
    cut = F.when(slash > 0, slash).otherwise(F.locate("?", bare) - 1)
    return _before(F.right(bare, F.length(bare) - cut), "?")


def url_parameter(url: Column, name: str) -> Column:
    """Value after the first ``name=``, up to the next ``&``; NULL where absent or empty."""
    tail = F.split_part(url, F.lit(f"{name}="), F.lit(2))
    return F.nullif(_before(tail, "&"), F.lit(""))


def with_url_parts(df: DataFrame, url: str, parameters: tuple[str, ...] = ()) -> DataFrame:
    """Add ``url_host``, ``url_path`` and one column per query parameter."""
    parts = {"url_host": url_host(F.col(url)), "url_path": url_path(F.col(url))}
    parts.update({name: url_parameter(F.col(url), name) for name in parameters})
    return df.withColumns(parts)
