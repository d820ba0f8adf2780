"""Hash keys over several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Existing keys were hashed with this text in place of NULL and this text between fields.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols: Column, nulls_as_empty: bool = False) -> Column:
    """md5 over the joined texts of the columns; use integers, texts, booleans and dates only."""
    token = "" if nulls_as_empty else NULL_TOKEN
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(token)) for c in cols]))
