"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.session import staged as written  # noqa: F401  what later steps start from

SPACES = r"\x20\x09-\x0D"  # what separates words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BITS = 1 << 23


def bitmap(df: DataFrame, hashed: Column, bits: int = BITS) -> bytes:
    """Which of ``bits`` cells the hashes fall in, as bytes: its size does not depend on the rows.

    Words of the bitmap are aggregated in Spark, so the driver gets bits / 64 rows at most.
    """
    cell = hashed.bitwiseAND(F.lit(bits - 1))
    words = df.groupBy(F.shiftright(cell, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    out = np.zeros(bits // 64, np.uint64)
    for word, value in words.collect():
        if word is not None:
            out[word] = np.uint64(value & (2**64 - 1))
    return out.tobytes()


def bitmap_hits(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the (unsigned 64-bit) hashes fall in a set cell."""
    words = np.frombuffer(bits, np.uint64)
    cell = hashes & np.uint64(len(words) * 64 - 1)
    return (words[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


ARCHIVE, BATCH_BYTES = "harborline-code.zip", 8 << 20


def ship_code(spark: SparkSession) -> None:
    """Gives this package to the executors' Python once per application, by Spark's own file distribution."""
    if any(name.endswith(ARCHIVE) for name in spark.sparkContext.listFiles):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="harborline-code-")) / ARCHIVE
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow with this package at hand in the tasks, and in batches of BATCH_BYTES at most.

    The size of batches is a setting of the session; it is lowered, since texts are long, and never raised, and it stays
    lowered: the frame that is returned runs later, and reads the setting then.
    """
    ship_code(df.sparkSession)
    conf, setting = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(setting).removesuffix("b")) not in range(1, BATCH_BYTES + 1):
        conf.set(setting, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """row (all columns as a struct) and key (a number of its own for every row), written: ids may repeat or lack, and
    columns may have any name."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return written(docs.select(row, F.monotonically_increasing_id().alias("key")), label)


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows (of ``numbered``, as they were before) whose key is not in ``gone`` (a written table with the column key).

    Rows outside a bitmap of fixed size stay where they are; only the others, the gone ones and a few beside them, are
    shuffled for the exact join.
    """
    import pandas as pd  # only here: the tasks of the other operators do without it

    spark = rows.sparkSession
    ship_code(spark)
    bits = spark.sparkContext.broadcast(bitmap(gone, F.xxhash64("key")))

    def may_be_gone(hashes: pd.Series) -> pd.Series:
        return pd.Series(bitmap_hits(bits.value, hashes.to_numpy(np.int64).view(np.uint64)))

    may_be_gone.__annotations__ = {"hashes": pd.Series, "return": pd.Series}
    may_be_gone = F.pandas_udf(may_be_gone, "boolean")
    marked = rows.select("row", "key", may_be_gone(F.xxhash64("key")).alias("maybe"))
    rest = marked.where("maybe").join(gone.select("key"), "key", "left_anti")
    kept = marked.where("NOT maybe").select("row").union(rest.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in rows.schema["row"].dataType.names])


def sampled(rows: DataFrame, key: str, group: str, per_group: int) -> DataFrame:
    """For each value of ``group`` the ``per_group`` rows with the smallest hash of their key; groups are few.

    Rows are thinned by hash to some twice that many before any group meets, so no group is large when it is ranked.
    """
    spread = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.lit(1.0)
    for value, count in rows.groupBy(group).agg(F.count("*")).collect():
        share = F.when(F.col(group) == value, F.lit(min(1.0, (2 * per_group + 50) / count))).otherwise(share)
    ranked = rows.withColumn("_spread", spread).where(F.col("_spread") < share).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(group).orderBy("_spread", key)))
    return ranked.where(F.col("_rank") <= per_group).drop("_spread", "_rank")
