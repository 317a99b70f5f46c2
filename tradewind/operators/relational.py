"""Join and grouping shapes the warehouse builds share."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.sources import schemas

log = logging.getLogger(__name__)


def spread_nulls(key: Column, row_id: Column) -> Column:
    """A join key that never matches for NULL, spread over partitions by ``row_id``.

    Without it every NULL key of an outer join hashes to one task.
    """
    return F.coalesce(key, F.concat(F.lit("~"), row_id))


def align(df: DataFrame, table: str) -> DataFrame:
    """Match columns to a declared table by name, ignoring case.

    Missing columns become NULL, unknown ones are dropped with a warning, order and
    types follow the table. NaN becomes NULL.
    """
    declared = schemas.columns(table)
    present = {name.lower(): (name, dtype) for name, dtype in df.dtypes}
    extra = sorted(set(present) - {name for name, _ in declared})
    if extra:
        log.warning("%s: dropping columns it does not declare: %s", table, extra)

    def aligned(name: str, dtype: str) -> Column:
        if name not in present:
            return F.lit(None).cast(dtype).alias(name)
        source, source_type = present[name]
        value = F.col(f"`{source}`")
        if source_type in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        return (value if source_type == dtype else value.cast(dtype)).alias(name)

    return df.select([aligned(name, dtype) for name, dtype in declared])


def with_member(df: DataFrame, table: str, **values) -> DataFrame:
    """Add the fixed member of a dimension (Unknown, No Discount) as one literal row."""
    row = df.sparkSession.range(1).select(
        [F.lit(values.get(name)).cast(dtype).alias(name) for name, dtype in schemas.columns(table)]
    )
    return df.unionByName(row)


def packed(df: DataFrame, key: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``key`` and one struct of the other columns.

    A chain of joins over packed frames moves one value per input. Spread over dozens of
    columns, the generated join code outgrows what the JVM compiles and is interpreted.
    """
    columns = columns or [c for c in df.columns if c != key]
    return df.select(key, F.struct(*columns).alias(name))


def join_packed(base: DataFrame, key: str, parts: Mapping[str, DataFrame]) -> DataFrame:
    """Left-join packed parts on ``key`` and lay all columns out again."""
    out = packed(base, key, "_base")
    for name, part in parts.items():
        out = out.join(packed(part, key, name), key, "left")
    return out.select(key, "_base.*", *[f"{name}.*" for name in parts])


def first_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group with their rank in ``_rank``.

    The rank filter lets Spark cut each group to ``limit`` rows before the shuffle
    as well, so one huge group never reaches a single task.
    """
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= limit)


def ordinal_pivot(
    df: DataFrame, group: str, order: Sequence[Column], width: int, fields: Mapping[str, str]
) -> DataFrame:
    """First ``width`` rows of each group laid out as columns.

    ``fields`` maps a source column to an output pattern such as ``tax_{}_rate``.
    """
    ranked = first_rows(df, [group], order, width)
    cells = [
        F.max(F.when(F.col("_rank") == slot, F.col(source))).alias(pattern.format(slot))
        for slot in range(1, width + 1)
        for source, pattern in fields.items()
    ]
    return ranked.groupBy(group).agg(*cells)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``. Rows with a NULL key are all kept."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    kept = first_rows(df.filter(complete), keys, order, 1).drop("_rank")
    return kept.unionByName(df.filter(~complete))


def labelled_counts(frames: Mapping[str, DataFrame], label: str, count: str = "n") -> DataFrame:
    """``UNION ALL`` of one labelled count per frame."""
    parts = [df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count) for name, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. A NULL key groups with other NULLs."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def completeness(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Row count and the number of filled values of each column, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count(c).alias(f"{c}_filled") for c in columns]
    )
