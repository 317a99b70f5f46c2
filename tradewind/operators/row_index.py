"""Global row numbers and tiles without a single-task window.

A bare ``Window.orderBy`` moves every row into one task. Here only the sort keys go
through a range shuffle; each task numbers its own sorted slice, the slice is
written to the shared folder, and slice offsets (one row per partition) turn the
local positions into global ones. Hot key values are harmless as long as the last
sort column is unique, because the range bounds then fall inside the hot value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.session import scratch_path

#: What numbers the rows of a build: (frame, sort columns, name of the number). The last sort column is unique.
Numbering = Callable[[DataFrame, Sequence[str], str], DataFrame]

# monotonically_increasing_id(): partition number above bit 33, row position below it.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def _numbered_slices(df: DataFrame, order_by: Sequence[Column | str], partitions: int | None):
    spark = df.sparkSession
    spread = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    path = scratch_path(spark, "row-index")
    (
        spread.sortWithinPartitions(*order_by)
        .withColumn("_pos", F.monotonically_increasing_id())
        .write.option("compression", "zstd")
        .parquet(path)
    )
    # Read back what was written: later use can never re-sample the range bounds.
    slices = spark.read.parquet(path)
    counts = (
        slices.groupBy(F.shiftright("_pos", _POSITION_BITS).alias("_slice")).count().orderBy("_slice").collect()
    )  # at most one row per partition
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["_slice"], total))
        total += row["count"]
    return slices, offsets, total


def _with_position(slices: DataFrame, offsets: list, name: str) -> DataFrame:
    """Add the zero-based global position."""
    local = F.col("_pos").bitwiseAND(F.lit(_POSITION_MASK))
    if len(offsets) <= 1:
        return slices.withColumn(name, local).drop("_pos")
    # An Arrow table becomes a local relation; a list of rows would start Python workers.
    columns = [pa.array(column, pa.int64()) for column in zip(*offsets)]
    table = slices.sparkSession.createDataFrame(pa.table(columns, names=["_slice", "_offset"]))
    return (
        slices.withColumn("_slice", F.shiftright("_pos", _POSITION_BITS))
        .join(F.broadcast(table), "_slice")  # bounded by the partition count
        .withColumn(name, F.col("_offset") + local)
        .drop("_pos", "_slice", "_offset")
    )


def row_index(
    df: DataFrame, order_by: Sequence[Column | str], name: str, start: int = 1, partitions: int | None = None
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)`` for a frame of keys.

    Pass the narrow frame (sort keys and join key) and join the result back.
    """
    slices, offsets, _ = _numbered_slices(df, order_by, partitions)
    return _with_position(slices, offsets, name).withColumn(name, F.col(name) + F.lit(start))


def tile_of(position: Column, total: int, tiles: int) -> Column:
    """Tile of a zero-based position; the first ``total % tiles`` tiles hold one row more."""
    small, extra = divmod(total, tiles)
    if small == 0:
        return (position + 1).cast("int")
    boundary = extra * (small + 1)
    in_large = F.floor(position / F.lit(small + 1)) + 1
    in_small = F.floor((position - boundary) / F.lit(small)) + extra + 1
    return F.when(position < boundary, in_large).otherwise(in_small).cast("int")


def tile_index(
    df: DataFrame, order_by: Sequence[Column | str], tiles: int, name: str, partitions: int | None = None
) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY ...)`` for a frame of keys."""
    slices, offsets, total = _numbered_slices(df, order_by, partitions)
    return _with_position(slices, offsets, name).withColumn(name, tile_of(F.col(name), total, tiles))
