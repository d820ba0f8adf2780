"""Order-dependent operators that never put one group, or one table, into one task.

``lag``, ``lead`` and dense row numbers need a total order.  A plain window sorts each group (or the whole
table, without groups) in a single task, which a hot key turns into the slowest task of the job.  Here
the rows are cut into ranges of the complete order - group columns first, then the order columns, then
a hash of the row and its place in the input - so a hot group simply spans several ranges, and so does a pile of
equal rows.  There is one plan for tables of every size: at least one range for each shuffle partition of the
session, and more where a range would hold over ``rows_per_range`` rows.

The input is evaluated once, into the shared folder, with its tie-breakers: the only job that runs while the plan is
built, and the only copy.  Bounds of the ranges are drawn from that copy by a hash of each row's place, so every step and
every recomputed task finds the same ones, and each row finds its range by binary search among them.  Rows then move
once, by the number of their range, and the windows work inside the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.session import staged

ROWS_PER_RANGE = 250_000
RANGES_PER_TASK, SAMPLE_PER_RANGE = 4, 20
_CELLS = 1 << 30

_RANGE, _SEAM, _TIE, _PLACE, _BOUNDS = "__range", "__seam", "__tie", "__place", "__bounds"


def _comparable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _ranged(df: DataFrame, keys: Sequence[str], rows_per_range: int) -> tuple[DataFrame, list[str]]:
    """The rows with the number of their range, and the columns of the complete order."""
    tied = df.withColumns({_TIE: F.xxhash64(*_comparable(df)), _PLACE: F.monotonically_increasing_id()})
    written = Observation()  # counts the rows as they are written
    rows, full = staged(tied.observe(written, F.count(F.lit(1)).alias("rows")), "ordered"), [*keys, _TIE, _PLACE]
    tasks, count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), written.get["rows"]
    ranges = max(RANGES_PER_TASK * tasks, -(-count // rows_per_range))
    share = int(_CELLS * min(1.0, ranges * SAMPLE_PER_RANGE / max(count, 1)))
    drawn = rows.filter(F.pmod(F.xxhash64(_PLACE), F.lit(_CELLS)) < share)
    drawn = drawn.agg(F.sort_array(F.collect_list(F.struct(*full))).alias("all"))
    bounds = drawn.select(F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get(
        "all", F.floor(i * F.size("all") / ranges).cast("int")))).scalar()
    return place_among(rows, bounds, ranges - 1, full, _RANGE), full


def place_among(rows: DataFrame, bounds: Column, count: int, key: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: how many of ``count`` sorted bounds are not above the row's key, by binary search.

    ``bounds``: an array of structs like the key, as a scalar subquery; it is not copied into the rows.
    """
    rows = rows.withColumns({name: F.lit(0), _BOUNDS: bounds})
    for step in [1 << b for b in reversed(range(count.bit_length()))]:
        beyond = (F.col(name) + step <= count) & (F.get(_BOUNDS, F.col(name) + (step - 1)) <= F.struct(*key))
        rows = rows.withColumn(name, F.col(name) + F.when(beyond, step).otherwise(0))
    return rows.drop(_BOUNDS)


def in_ranges(df: DataFrame, order_by: Sequence[str], name: str = "range",
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The rows with the number of their range of the complete order, a range whole in one partition, ranges and rows
    sorted there: what a pass over the sorted rows with a bounded state needs.  A partition may hold several ranges."""
    ranged, full = _ranged(df, order_by, rows_per_range)
    ranged = ranged.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), _RANGE)
    return ranged.sortWithinPartitions(_RANGE, *full).withColumnRenamed(_RANGE, name).drop(_TIE, _PLACE)


def dense_ids(df: DataFrame, order_by: Sequence[str], name: str, start: int = 1,
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``name`` = start, start+1, ... without gaps, in the order of the given columns."""
    ranged, full = _ranged(df, order_by, rows_per_range)
    # One row per range, so the window below is over as many rows as there are ranges.
    earlier = F.sum("n").over(Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    offsets = (ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
               .select(F.col(_RANGE).alias("__of"), F.coalesce(earlier, F.lit(0)).alias("__before")))
    place = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*full))
    return (ranged.withColumn("__in", place).join(offsets, F.col(_RANGE) == F.col("__of"))
            .withColumn(name, (F.col("__in") + F.col("__before") + (start - 1)).cast("bigint"))
            .drop(_RANGE, _TIE, _PLACE, "__of", "__before", "__in"))


def _neighbour(df: DataFrame, values: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str],
               name: str, ahead: bool, rows_per_range: int) -> DataFrame:
    look, pick, towards = (F.lead, F.min_by, F.lag) if ahead else (F.lag, F.max_by, F.lead)
    ranged, keys = _ranged(df, [*partition_by, *order_by], rows_per_range)
    # The first (last) row of every range also goes to the nearest range before (after) it.
    kept = list(dict.fromkeys([*keys, *values]))
    edges = (ranged.groupBy(_RANGE)
             .agg(pick(F.struct(*kept), F.struct(*keys)).alias("edge"))
             .withColumn(_RANGE, towards(_RANGE).over(Window.orderBy(_RANGE)))
             .filter(F.col(_RANGE).isNotNull())
             .select(_RANGE, "edge.*", F.lit(True).alias(_SEAM)))
    rows = ranged.withColumn(_SEAM, F.lit(False)).unionByName(edges, allowMissingColumns=True)
    window = Window.partitionBy(_RANGE).orderBy(*keys)
    groups = {f"__g{i}": c for i, c in enumerate(partition_by)}
    found = {f"__v{i}": c for i, c in enumerate(values)}
    rows = rows.withColumns({"__there": look(F.lit(1)).over(window),
                             **{n: look(c).over(window) for n, c in {**groups, **found}.items()}})
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(c)) for n, c in groups.items()], F.col("__there").isNotNull())
    neighbour = F.struct(*[F.col(n).alias(c) for n, c in found.items()])
    return (rows.filter(~F.col(_SEAM)).withColumn(name, F.when(same, neighbour))
            .drop(_RANGE, _TIE, _PLACE, _SEAM, "__there", *groups, *found))


def with_previous(df: DataFrame, values: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str] = (),
                  name: str = "previous", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add struct ``name`` with ``values`` of the row before in the group; a NULL struct for the first row."""
    return _neighbour(df, values, order_by, partition_by, name, False, rows_per_range)


def with_next(df: DataFrame, values: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str] = (),
              name: str = "next", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add struct ``name`` with ``values`` of the row after in the group; a NULL struct for the last row."""
    return _neighbour(df, values, order_by, partition_by, name, True, rows_per_range)
