"""JSON-lines and CSV readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.session import staged

_CORRUPT = "__corrupt"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, required_keys: Sequence[str] = (),
                    required_values: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of a JSON-lines file; ``rejects`` holds the raw ``line`` and the ``reason``.

    A line is rejected if it is not valid JSON of the schema, lacks a required key (a key with NULL counts
    as present), or has NULL in a required value.  Blank lines are skipped.  The text is read and parsed once, by a
    job that writes good and rejected lines side by side into the shared folder; both results start from there.
    """
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    record = F.from_json("value", full, options).alias("r")
    keys = F.json_object_keys("value").alias("keys") if required_keys else F.lit(None).alias("keys")
    # Exploding a one-element array keeps the parse in one place: the filters below read its result, where
    # a plain projection would be copied into every condition that uses it.
    lines = (spark.read.text(path).filter(F.trim("value") != "")
             .select(F.col("value").alias("line"), F.explode(F.array(F.struct(record, keys))).alias("p"))
             .select("line", "p.r", "p.keys"))
    reason = F.when(F.col(f"r.{_CORRUPT}").isNotNull() | F.col("r").isNull(), F.lit("malformed"))
    if required_keys:
        absent = F.array_except(F.array(*map(F.lit, required_keys)), "keys")
        reason = reason.when(F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", ")))
    for name in required_values:
        reason = reason.when(F.col(f"r.`{name}`").isNull(), F.lit(f"null: {name}"))
    fine = F.col("reason").isNull()
    record = F.struct([F.col(f"r.`{f.name}`") for f in schema.fields])
    judged = lines.withColumn("reason", reason).select(
        F.when(fine, record).alias("record"), F.when(~fine, F.col("line")).alias("line"), "reason", fine.alias("fine"))
    judged = staged(judged, "json-lines", ["fine"])
    return judged.filter("fine").select("record.*"), judged.filter("not fine").select("line", "reason")


def read_csv_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and a fixed schema; an empty cell is NULL, a wrong cell fails the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
