"""Tables whose files are indexed by key, so that a load opens only the files that may hold one of its keys.

A table is a folder of Parquet files, sorted by key into ranges, and versions of a manifest.  A manifest has one row per
file, with the smallest and the largest key in it, and one per load: its batch, how many rows it wrote, and the last
number it gave.  A load writes new files first and the next version of the manifest last; that version counts once it is
written to its end, so a load that dies leaves the table as it was, a batch that is loaded again changes nothing, and
numbers go on without a gap.  Files that no manifest names any more stay until someone deletes them.

The manifest also keeps the schema of each load.  A later source may have columns more, or wider types (``on_change``, see
``drift``); files are read with the newest schema, in which a column that a file lacks is NULL.

The driver reads the manifest: one row per file.  Loads of one table must not run at the same time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.operators.drift import evolve
from harborline.operators.load import merge_by_key, new_rows, read_current, write_version
from harborline.operators.ordered import dense_ids, place_among
from harborline.operators.project import conform
from harborline.session import staged

ROWS_PER_FILE = 1_000_000


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    return read_current(spark, f"{path}/manifest")


def _files(spark: SparkSession, path: str, files: Sequence[str], schema: T.StructType) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{f}" for f in files])


def _split(manifest: DataFrame) -> tuple[list[Row], list[Row]]:
    """The manifest's rows on the driver: those of loads, in order, and those of files."""
    rows = manifest.collect()
    return sorted((r for r in rows if r["file"] is None), key=lambda r: r["load"]), [r for r in rows if r["file"] is not None]


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The rows, written, and their number."""
    seen = Observation()
    rows = staged(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return rows, seen.get["rows"]


def _schema(loads: Sequence[Row]) -> T.StructType:
    return T.StructType.fromJson(json.loads(loads[-1]["schema"]))


def _commit(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], kept: DataFrame | None, loads: Sequence[Row],
            batch: str | None, written: int, count: int, rows_per_file: int, last: int | None) -> None:
    """Writes the ``count`` rows as new files in ranges of the key, then the manifest that names them beside the ``kept``."""
    schema, folder, files = rows.schema, uuid.uuid4().hex, -(-count // rows_per_file)
    rows = rows.repartitionByRange(files, *keys) if files > 1 else rows.coalesce(1)
    rows.sortWithinPartitions(*keys).write.parquet(f"{path}/data/{folder}")
    key = F.struct(*keys)
    held = F.when(~F.greatest(*[F.isnull(k) for k in keys], F.lit(False)), key)  # a NULL key matches nothing
    name = F.substring_index("_metadata.file_path", "/", -2)
    found = spark.read.schema(schema).parquet(f"{path}/data/{folder}").groupBy(name.alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(held).alias("low"), F.max(held).alias("high"))
    if kept is not None:
        found = found.unionByName(kept.select("file", "rows", "low", "high"))
    load = [(r["load"], r["batch"], r["rows"], r["last"], r["schema"]) for r in loads]
    load.append((len(load) + 1, batch, written, last, json.dumps(schema.jsonValue())))
    noted = spark.createDataFrame(load, "load int, batch string, rows long, last long, schema string")
    write_version(found.unionByName(noted, allowMissingColumns=True).coalesce(1), f"{path}/manifest")


def create(df: DataFrame, path: str, keys: Sequence[str], rows_per_file: int = ROWS_PER_FILE, batch: str | None = None) -> DataFrame:
    """Writes ``df`` as a table indexed by ``keys``, and gives it back."""
    spark, (rows, count) = df.sparkSession, _counted(df, "indexed-input")
    _commit(spark, path, rows, keys, None, [], batch, count, count, rows_per_file, None)
    return read(spark, path)


def read(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    """The table as of its newest manifest, or only some of its files."""
    loads, stored = _split(_manifest(spark, path))
    return _files(spark, path, [r["file"] for r in stored] if files is None else files, _schema(loads))


def touched_files(spark: SparkSession, path: str, source: DataFrame) -> list[str]:
    """The files whose range of keys holds at least one key of ``source``.

    The ends of all ranges cut the keys into points and gaps; each key of the source finds its own by binary search, and
    the driver gets the numbers of those that were met: two per file at most.
    """
    zones = _manifest(spark, path).filter("low IS NOT NULL").select("file", "low", "high")
    keys = zones.schema["low"].dataType
    ends = [r[0] for r in zones.select(F.explode(F.array("low", "high"))).distinct().orderBy("col").collect()]
    if not ends:
        return []
    bounds = zones.agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.array("low", "high")))))).scalar()
    wanted = conform(source.select(*keys.names), keys).dropna()
    met = place_among(wanted.withColumn("__bound", bounds), bounds, len(ends), keys.names, "__place")
    met = met.select(F.when(F.get("__bound", F.col("__place") - 1).eqNullSafe(F.struct(*keys.names)), 2 * F.col("__place") - 1)
                     .otherwise(2 * F.col("__place")).alias("at")).distinct()
    hit = sorted(r["at"] for r in met.collect())
    place = {tuple(end): i for i, end in enumerate(ends)}
    spans = [(r["file"], 2 * place[tuple(r["low"])] + 1, 2 * place[tuple(r["high"])] + 1) for r in zones.collect()]
    return sorted(f for f, a, b in spans if _any_between(hit, a, b))


def _any_between(sorted_numbers: Sequence[int], low: int, high: int) -> bool:
    from bisect import bisect_left

    at = bisect_left(sorted_numbers, low)
    return at < len(sorted_numbers) and sorted_numbers[at] <= high


def batch_rows(spark: SparkSession, path: str, batch: str) -> int | None:
    """How many rows a batch wrote; None if it is not in the table."""
    manifest = _manifest(spark, path)
    return None if manifest is None else _written(_split(manifest)[0], batch)


def _written(loads: Sequence[Row], batch: str | None) -> int | None:
    return next((r["rows"] for r in loads if batch is not None and r["batch"] == batch), None)


def merge(spark: SparkSession, path: str, source: DataFrame, batch: str | None = None,
          rows_per_file: int = ROWS_PER_FILE, on_change: str = "ignore") -> DataFrame:
    """Merges ``source`` by key; only the files that may hold one of its keys are read, and written anew.

    A batch that the table has already changes nothing.  ``on_change`` says what becomes of new columns and wider types.
    """
    manifest = _manifest(spark, path)
    (loads, stored), keys = _split(manifest), manifest.schema["low"].dataType.names
    if _written(loads, batch) is None:
        schema = evolve(_schema(loads), source.schema, on_change, keys)
        source, given = _counted(conform(source, schema), "indexed-source")
        files = touched_files(spark, path, source)
        merged, count = _counted(merge_by_key(_files(spark, path, files, schema), source, keys), "indexed-merged")
        kept = manifest.filter(F.col("file").isNotNull() & ~F.col("file").isin(files))
        _commit(spark, path, merged, keys, kept, loads, batch, given, count, rows_per_file, loads[-1]["last"])
    return read(spark, path)


def append(spark: SparkSession, path: str, source: DataFrame, batch: str | None = None, null_safe: bool = False,
           number: str | None = None, order_by: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE,
           on_change: str = "ignore") -> DataFrame:
    """Appends the rows whose key the table lacks; only the files that may hold one of the keys are read.

    ``number`` names a column of the table that counts on, in the order of ``order_by``, from the last number of the
    loads before.  A batch that the table has already changes nothing, whatever its keys.  ``on_change`` says what becomes
    of new columns and wider types.
    """
    manifest = _manifest(spark, path)
    (loads, stored), keys = _split(manifest), manifest.schema["low"].dataType.names
    if _written(loads, batch) is None:
        schema = evolve(_schema(loads), source.schema, on_change, keys)
        source = staged(source, "indexed-source")
        files = [r["file"] for r in stored] if null_safe else touched_files(spark, path, source)
        slim = [f.name for f in schema.fields if f.name != number]
        fresh = new_rows(_files(spark, path, files, schema).select(*slim), source, keys, null_safe)
        last = loads[-1]["last"] or 0
        if number is not None:
            fresh = dense_ids(fresh, order_by or keys, number, start=last + 1)
        fresh, count = _counted(conform(fresh, schema), "indexed-fresh")
        last = last + count if number is not None else loads[-1]["last"]
        _commit(spark, path, fresh, keys, manifest.filter("file IS NOT NULL"), loads, batch, count, count, rows_per_file, last)
    return read(spark, path)
