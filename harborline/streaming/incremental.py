"""New landing files appended as they arrive.

The same append as the batch load, driven by a file stream.  A batch that is retried after a failure
finds its rows in the target already, so rows with a key are written once.  Where rows may have a NULL key, or the target is
indexed, ``stream_append_batches`` notes each batch with its rows, so that a retried one changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from harborline.operators import indexed
from harborline.operators.load import append_new


def stream_append_new(spark: SparkSession, landing: str, schema: T.StructType, target: str, checkpoint: str,
                      keys: Sequence[str], transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                      max_files_per_batch: int = 1000) -> StreamingQuery:
    """Take the parquet files in ``landing`` not yet seen, transform them and append the rows the target lacks.

    Stops once the files present at the start are loaded.  ``checkpoint`` lies in a shared folder.
    """
    def load(batch: DataFrame, _: int) -> None:
        append_new(batch.sparkSession, transform(batch).distinct(), target, keys)

    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_batch).parquet(landing)
            .writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_append_batches(spark: SparkSession, landing: str, schema: T.StructType, path: str, checkpoint: str,
                          transform: Callable[[DataFrame], DataFrame] = lambda df: df, max_files_per_batch: int = 1000,
                          **options) -> StreamingQuery:
    """As ``stream_append_new``, into the table indexed by key at ``path``, each batch once.

    A batch is named by the stream, as its checkpoint knows it, and by its number; a stream with a new checkpoint is
    another one.  ``options`` are those of ``indexed.append``: numbers that go on, NULL keys that match, changed schemas.
    """
    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        indexed.append(session, path, transform(batch).distinct(), batch=f"{stream}/{number}", **options)

    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_batch).parquet(landing)
            .writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
