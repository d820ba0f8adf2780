"""Named queries over the test tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from harborline.sources.tables import read_table


class Tables:
    """The test tables of one scale factor as attributes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        table = read_table(self.spark, self.root, name)
        setattr(self, name, table)  # look the file up once
        return table


@dataclass(frozen=True)
class Entry:
    run: Callable[[Tables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""
    def add(function: Callable[[Tables], DataFrame]):
        if function.__name__ in ENTRIES:
            raise ValueError(f"{function.__name__} is registered twice")
        ENTRIES[function.__name__] = Entry(function, sql)
        return function

    return add
