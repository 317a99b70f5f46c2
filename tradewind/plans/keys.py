"""Surrogate keys that stay the same over rebuilds.

A registry table holds the number of every natural key that was ever numbered. Known keys keep theirs; only new ones are
numbered, from the highest on, in the order that a first build would use. The registry grows by the new keys of a load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.row_index import row_index
from tradewind.sources.tables import TableStore


class KeyRegistry:
    """Numbers rows like ``row_index``, whose place it can take in a build."""

    def __init__(self, store: TableStore):
        self.store = store

    def table(self, name: str) -> str:
        return f"keys_{name}"

    def number(self, df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
        """``df`` with the registered number of each row as ``name``; the last column of ``order_by`` is the natural key."""
        natural, table = order_by[-1], self.table(name)
        start = 1
        fresh = df
        if self.store.exists(table):
            known = self.store.read(table)
            start += known.agg(F.coalesce(F.max("surrogate_key"), F.lit(0)).alias("m")).first()["m"]
            fresh = df.join(known.select(F.col("natural_key").alias(natural)), natural, "left_anti")
        new = row_index(fresh.select(*order_by), order_by, "surrogate_key", start)
        entries = new.select(F.col(natural).cast("string").alias("natural_key"), "surrogate_key")
        self.store.load_full(table, entries, truncate=False)
        keys = self.store.read(table).select(F.col("natural_key").alias(natural), F.col("surrogate_key").alias(name))
        return df.join(keys, natural)
