"""Stored tables: full load, keyed upsert, replacement by parent, snapshot partitions, retention.

Tables are managed Parquet tables in a database of Spark's catalog whose location is the store's root. Spark creates,
overwrites and drops them; the store only chooses partitions. A table that takes upserts is dealt into buckets of its key, a
snapshot table into days. A batch is staged as a table of its own first; then the partitions that it touches are read,
merged with it and overwritten by Spark's dynamic partition overwrite, which changes the table when the job commits and not
before. So a load that fails leaves the table as it was, and a repeat gives what the first run would have given.

A full load of a table that holds rows is staged as well, so that only a copy is left to do when the old rows go. Use a
catalog that lasts, such as a metastore, to open a store again from another application.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.relational import align, latest_per_key
from tradewind.sources import schemas

# Newest first, when a batch holds the same key twice.
_RECENCY = ("updated_at", "extracted_at")
KEY_BUCKET = "key_bucket"
RETIRED = "retired_partitions"


class TableStore:
    """``buckets`` is the number of parts an upserted or co-located table is kept in, or what tells it when first needed.

    Choose it so that a bucket fits a task's memory: one task sorts and joins it.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | Callable[[], int] = 8):
        self.spark, self.root, self._buckets = spark, root.rstrip("/"), buckets
        self.database = "store_" + hashlib.md5(self.root.encode()).hexdigest()[:16]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")

    @cached_property
    def buckets(self) -> int:
        return self._buckets if isinstance(self._buckets, int) else self._buckets()

    # --- catalogue --------------------------------------------------------------
    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create_if_absent(self, table: str) -> bool:
        """Create an empty table from its declared schema; False when it was there."""
        if self.exists(table):
            return False
        self.load_full(table, self.spark.range(0).drop("id"))
        return True

    def columns(self, table: str) -> list[str]:
        """Column names in declared order; an error when the table does not exist."""
        return self.read(table).columns

    def count(self, table: str) -> int:
        return self.read(table).count()

    def partition_of(self, table: str) -> str | None:
        """The column that deals the table into partitions."""
        return next((c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition), None)

    def partitions(self, table: str) -> list[str]:
        """The partitions of a table as ``column=value``."""
        return sorted(r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect())

    # --- scans ------------------------------------------------------------------
    def read(self, table: str, hidden: Sequence[str] = ()) -> DataFrame:
        """Scan a table with its declared columns, and ``hidden`` ones that it is dealt by. Filters on partitions prune them."""
        if not self.exists(table):
            raise LookupError(f"no such table: {table}")
        df = self.spark.table(self.name(table))
        if self.exists(RETIRED) and table != RETIRED:
            gone = [r.partition_value for r in self._retired(table).collect()]  # one row for each retired partition
            if gone:
                df = df.filter(~F.coalesce(F.col(self.partition_of(table)).cast("string"), F.lit("")).isin(gone))
        return df.select([name for name, _ in schemas.columns(table)] + list(hidden))

    def _retired(self, table: str) -> DataFrame:
        return self.spark.table(self.name(RETIRED)).filter(F.col("table_name") == table)

    # --- staging ----------------------------------------------------------------
    @contextmanager
    def _staged(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` as a written table, dropped at the end."""
        stage = self.name(f"stage_{uuid.uuid4().hex}")
        try:
            df.write.format("parquet").option("compression", "zstd").saveAsTable(stage)
            yield self.spark.table(stage)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {stage}")

    def _writer(self, df: DataFrame, by: str | None) -> DataFrameWriter:
        writer = df.write.format("parquet").options(partitionOverwriteMode="dynamic", compression="zstd")
        return writer.partitionBy(by) if by else writer

    def _overwrite(self, table: str, df: DataFrame) -> None:
        """Overwrite the partitions that ``df`` has rows for; a table without partitions as a whole."""
        by = self.partition_of(table)
        layout = self.spark.table(self.name(table)).columns
        (df.hint("rebalance", by) if by else df).select(layout).write.insertInto(self.name(table), overwrite=True)

    def _drop_partitions(self, table: str, values: Sequence) -> None:
        by = self.partition_of(table)
        shown = ["null" if v is None else f"'{v}'" if isinstance(v, (str, date)) else str(v) for v in values]
        if shown:
            parts = ", ".join(f"PARTITION ({by} = {v})" for v in shown)
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {parts}")

    def _values(self, df: DataFrame, by: str) -> list:
        """The partitions that rows belong to: few, buckets, days or months."""
        return [r[0] for r in df.select(by).distinct().collect()]

    # --- full loads -------------------------------------------------------------
    def bucket_of(self, table: str, keys: Sequence[str] = ()) -> Column:
        """The bucket of a row of a table that is dealt by its key or its parent."""
        dealt_by = schemas.BUCKET_KEYS.get(table) or schemas.STAGING_KEYS.get(table) or keys
        return F.pmod(F.xxhash64(*dealt_by), F.lit(self.buckets)).cast("int")

    def load_full(
        self,
        table: str,
        df: DataFrame,
        truncate: bool = True,
        partition_by: str | tuple[str, Column] | None = None,
        sort_by: Sequence[str] = (),
        co_locate: tuple[str, Callable[[], Column]] | None = None,
        dealt: bool = True,
        placed: bool = False,
    ) -> int:
        """Replace the table (or append with ``truncate=False``); returns the rows loaded.

        ``partition_by`` deals the rows into one folder for each value of a column, declared or (name, expression); filters on
        it prune folders. ``co_locate`` (name, expression) writes Spark buckets of that column, so that tables with the same
        number of them join on it without a shuffle; rows that lie by it already (``placed``) are not moved. A keyed staging table is dealt into buckets of its key, unless ``dealt``
        is off because it will take no upserts. ``sort_by`` orders rows inside each file, so that row groups can be skipped.
        """
        aligned = align(df, table)
        if not truncate and self.exists(table):
            return self._append(table, aligned)
        by = partition_by if isinstance(partition_by, str) or partition_by is None else partition_by[0]
        if by is None and dealt and not co_locate and table in schemas.STAGING_KEYS:
            by, aligned = KEY_BUCKET, aligned.withColumn(KEY_BUCKET, self.bucket_of(table))
        elif partition_by is not None and not isinstance(partition_by, str):
            aligned = aligned.withColumn(*partition_by)
        if self.exists(table):
            with self._staged(aligned) as staged:
                self._replace(table, staged, by, sort_by, co_locate)
                return staged.count()
        self._create(table, aligned, by, sort_by, co_locate, placed)
        return self.spark.table(self.name(table)).count()

    def _create(
        self, table: str, df: DataFrame, by: str | None, sort_by: Sequence[str] = (), co_locate: tuple[str, Callable[[], Column]] | None = None, placed: bool = False
    ) -> None:
        if co_locate:
            df = df.withColumn(co_locate[0], co_locate[1]())
            df = df if placed else df.repartition(self.buckets, co_locate[0])
        elif by:  # few files for each folder; large ones are split
            df = df.hint("rebalance", by)
        if sort_by:
            df = df.sortWithinPartitions(*([by] if by else []), *sort_by)
        writer = self._writer(df, by)
        if co_locate:
            writer = writer.bucketBy(self.buckets, co_locate[0])
        writer.saveAsTable(self.name(table))

    def _replace(self, table: str, staged: DataFrame, by: str | None, sort_by: Sequence[str], co_locate: tuple[str, Callable[[], Column]] | None) -> None:
        if by is None or co_locate or by != self.partition_of(table):
            self.spark.sql(f"DROP TABLE {self.name(table)}")
            self._create(table, staged, by, sort_by, co_locate)
            return
        before, now = self._values(self.spark.table(self.name(table)), by), self._values(staged, by)
        self._overwrite(table, staged.sortWithinPartitions(by, *sort_by) if sort_by else staged)
        self._drop_partitions(table, [v for v in before if v not in now])

    def _append(self, table: str, aligned: DataFrame) -> int:
        by = self.partition_of(table)
        if by == KEY_BUCKET:
            aligned = aligned.withColumn(KEY_BUCKET, self.bucket_of(table))
        with self._staged(aligned) as staged:
            layout = self.spark.table(self.name(table)).columns
            staged.select(layout).write.insertInto(self.name(table))
            return staged.count()

    # --- merges -----------------------------------------------------------------
    def _latest(self, table: str, df: DataFrame, keys: Sequence[str], newest: Sequence[Column] | None) -> DataFrame:
        source = align(df, table)
        if newest is None:
            newest = [F.col(c).desc_nulls_last() for c in _RECENCY if c in source.columns]
        # The remaining columns settle ties, so the survivor does not depend on row order.
        rest = [F.col(c) for c in source.columns if c not in keys]
        return latest_per_key(source, keys, [*newest, *rest])

    def upsert(self, table: str, df: DataFrame, keys: Sequence[str] | None = None, newest: Sequence[Column] | None = None) -> int:
        """Update matching keys, insert the rest. Idempotent but for NULL keys, which never match.

        Only the buckets of the key that the source touches are written again. Returns the number of source rows
        merged; an empty source changes nothing.
        """
        keys = keys or schemas.STAGING_KEYS[table]
        source = self._latest(table, df, keys, newest)
        source = source.withColumn(KEY_BUCKET, self.bucket_of(table, keys))
        return self._merge(table, source, KEY_BUCKET, lambda rows, staged: rows.join(staged.select(*keys), list(keys), "left_anti"), keys=keys)

    def upsert_partitions(self, table: str, df: DataFrame, partition: str, keys: Sequence[str] | None = None) -> int:
        """Upsert that writes only the partitions the source touches.

        For tables whose key contains the partition column, such as daily snapshots:
        a repeated run of the same day replaces its rows, earlier days stay as they are.
        """
        keys = keys or schemas.STAGING_KEYS[table]
        source = self._latest(table, df, keys, None)
        return self._merge(table, source, partition, lambda rows, staged: rows.join(staged.select(*keys), list(keys), "left_anti"))

    def replace_children(self, table: str, df: DataFrame, parents: DataFrame, parent: str | None = None) -> int:
        """Remove all rows of ``parents`` (one column of ids) and insert ``df``, their rows now.

        A child that its parent no longer has goes, also where children are keyed by their place in a list. The table is dealt
        by its parent (``BUCKET_KEYS``), so only the buckets of changed parents are written again.
        """
        parent = parent or schemas.BUCKET_KEYS[table][0]
        ids = parents.select(F.col(parents.columns[0]).alias(parent)).distinct()
        source = align(df, table).withColumn(KEY_BUCKET, self.bucket_of(table))
        with self._staged(ids) as changed:
            buckets = changed.select(self.bucket_of(table).alias(KEY_BUCKET))
            return self._merge(table, source, KEY_BUCKET, lambda rows, staged: rows.join(changed, parent, "left_anti"), buckets)

    def _merge(
        self,
        table: str,
        source: DataFrame,
        by: str,
        kept: Callable[[DataFrame, DataFrame], DataFrame],
        also: DataFrame | None = None,
        keys: Sequence[str] = (),
    ) -> int:
        """Overwrite the partitions of the staged source (and of ``also``) with the rows ``kept`` of them and the source."""
        with self._staged(source) as staged:
            merged = staged.count()
            if not self.exists(table):
                self._create(table, staged, by)
                return merged
            if self.partition_of(table) != by:  # the first merge deals the whole table
                dealt = self.spark.table(self.name(table)).select([n for n, _ in schemas.columns(table)])
                dealt = dealt.withColumn(by, self.bucket_of(table, keys)) if by == KEY_BUCKET else dealt
                with self._staged(dealt) as whole:
                    self._replace(table, whole, by, (), None)
            touched = self._values(staged if also is None else staged.select(by).union(also), by)
            if not touched:
                return 0
            rows = self.spark.table(self.name(table))
            some = rows.filter(F.col(by).isin([v for v in touched if v is not None]) | (F.col(by).isNull() if None in touched else F.lit(False)))
            self._overwrite(table, kept(some, staged).select(rows.columns).unionByName(staged.select(rows.columns)))
            bare = [v for v in touched if v not in self._values(staged, by)] if also is not None else []
            if bare:  # partitions without new rows stay as they are above: those without old rows either go
                left = self._values(kept(rows.filter(F.col(by).isin(bare)), staged), by)
                self._drop_partitions(table, [v for v in bare if v not in left])
            return merged

    # --- retention --------------------------------------------------------------
    def retain(self, table: str, expired: Callable[[str], bool], soft: bool = False) -> list[str]:
        """Remove the partitions whose value (as text) has ``expired``; returns their values.

        Removed partitions are dropped with their files. With ``soft`` they are entered in a table of retired partitions
        instead: reads leave them out, and ``restore`` brings them back.
        """
        by = self.partition_of(table)
        if by is None or by == KEY_BUCKET:
            raise ValueError(f"{table} is not kept in partitions of time")
        values = [p.split("=", 1)[1] for p in self.partitions(table)]
        old = [v for v in values if v != "__HIVE_DEFAULT_PARTITION__" and expired(v)]
        if soft:
            if not self.exists(RETIRED):
                self.create_if_absent(RETIRED)
            known = {r.partition_value for r in self._retired(table).collect()}
            rows = [(table, v) for v in old if v not in known]
            if rows:
                new = self.spark.createDataFrame(rows, "table_name string, partition_value string").withColumn("retired_at", F.current_timestamp())
                self.load_full(RETIRED, new, truncate=False)
            return old
        self._drop_partitions(table, old)
        return old

    def restore(self, table: str) -> None:
        """Bring back the retired partitions of a table."""
        if self.exists(RETIRED):
            others = self.spark.table(self.name(RETIRED)).filter(F.col("table_name") != table)
            self.load_full(RETIRED, others)
