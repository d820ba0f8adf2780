"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "harborline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library assumes (UTC, ANSI, adaptive plans)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot key of a join even where that costs the aggregate above it an extra shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder for tables that must be written between two steps of a job.

    A cluster names it in ``spark.checkpoint.dir``, and must; in local mode, where that is unset, it is a folder beside
    the warehouse's tables.  Each application has a folder of its own under it.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    return f"{base.rstrip('/')}/harborline-{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "staged", partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back, for work that goes over it several times.  Runs a job."""
    path = staging_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> bool:
    """Deletes what this application has staged; for the end of a job, when its results are written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
