"""Named tables, and tables found by a name pattern."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.operators.setops import union_relations


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Table ``name`` stored as ``<root>/<name>.parquet``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def like_regex(pattern: str) -> re.Pattern:
    """SQL LIKE pattern as a case-insensitive regular expression."""
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(c, re.escape(c)) for c in pattern), re.IGNORECASE | re.DOTALL)


def _matching(names: list[str], pattern: str, exclude: str) -> list[str]:
    take, skip = like_regex(pattern), like_regex(exclude)
    return sorted(n for n in names if take.fullmatch(n) and not skip.fullmatch(n))


def catalog_tables(spark: SparkSession, schema_pattern: str, table_pattern: str,
                   exclude: str = "") -> dict[str, DataFrame]:
    """Catalog tables ``schema.table`` by case-insensitive LIKE patterns."""
    found = {}
    for schema in _matching([d.name for d in spark.catalog.listDatabases()], schema_pattern, ""):
        names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
        for name in _matching(names, table_pattern, exclude):
            found[f"{schema}.{name}"] = spark.table(f"`{schema}`.`{name}`")
    return found


def catalog_tables_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> dict[str, DataFrame]:
    return catalog_tables(spark, schema, f"{prefix}%", exclude)


def stored_tables(spark: SparkSession, root: str, table_pattern: str, exclude: str = "") -> dict[str, DataFrame]:
    """Tables stored under ``root`` by a name pattern, on any file system Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName().removesuffix(".parquet") for f in files
             if f.getPath().getName().endswith(".parquet")]
    return {n: read_table(spark, root, n) for n in _matching(names, table_pattern, exclude)}


def like_tables(spark: SparkSession, root: str, table_pattern: str, exclude: str = "",
                source_column_name: str = "source_relation") -> DataFrame:
    """UNION ALL of the tables stored under ``root`` by a name pattern, in one scan per schema among them.

    Tables with the same columns are read together, whatever their number; a row's table is told by the name of its file.
    A column that a schema lacks is NULL there.  Schemas are read from the files, one after the other.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    stored = [f.getPath().getName().removesuffix(".parquet") for f in files if f.getPath().getName().endswith(".parquet")]
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for name in _matching(stored, table_pattern, exclude):
        schema = read_table(spark, root, name).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(f"{root}/{name}.parquet")
    if not groups:
        raise ValueError(f"no table under {root} is like {table_pattern!r}")
    table = F.url_decode(F.regexp_extract("_metadata.file_path", r"([^/]+)\.parquet(?:/[^/]+)?$", 1))
    parts = {key: spark.read.schema(schema).parquet(*paths).select(table.alias(source_column_name), "*")
             for key, (schema, paths) in groups.items()}
    return union_relations(parts, source_column_name=None)
