"""Full and incremental loads of staging tables from source documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import parse_utc
from tradewind.operators import flatten as fl
from tradewind.operators.flatten import ORDER_FLATTENERS
from tradewind.operators.relational import duplicate_keys
from tradewind.sources import schemas
from tradewind.sources.tables import TableStore

MODES = ("full", "incremental", "auto")
PARENT = "stg_orders"
MARKS = "etl_marks"


@dataclass(frozen=True)
class LoadResult:
    table: str
    mode: str
    rows: int


def resolve_mode(store: TableStore, table: str, mode: str) -> str:
    """``auto`` means full for an empty or missing table, incremental otherwise."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}: use one of {', '.join(MODES)}")
    if mode != "auto":
        return mode
    filled = store.exists(table) and not store.read(table).isEmpty()
    return "incremental" if filled else "full"


def high_water_mark(store: TableStore, table: str = PARENT) -> datetime | None:
    """How far a table has been loaded, NULL for an empty or missing table.

    That is the mark committed after its last load, or the latest ``updated_at`` it holds if it was filled otherwise.
    """
    if not store.exists(table):
        return None
    if store.exists(MARKS):
        mark = store.read(MARKS).filter(F.col("entity") == table).first()
        if mark is not None:
            return mark["high_water"]
    if "updated_at" not in store.columns(table):
        return None
    return store.read(table).agg(F.max("updated_at")).first()[0]


def commit_mark(store: TableStore, table: str, mark: datetime | None, run_ts: datetime) -> None:
    """Enter how far a table is loaded, after its rows are in. A load that failed leaves the mark before it."""
    if mark is None:
        return
    store.create_if_absent(MARKS)
    entry = store.spark.createDataFrame(pa.table({"entity": [table]})).withColumns(
        {"high_water": F.lit(mark).cast("timestamp_ntz"), "updated_at": F.lit(run_ts).cast("timestamp_ntz")}
    )
    store.upsert(MARKS, entry, ["entity"])


def changed_since(docs: DataFrame, mark: datetime, lookback_days: int = 0) -> DataFrame:
    """Documents updated at or after the mark.

    The boundary document is read again on purpose: the upsert makes that harmless.
    """
    start = F.lit(mark - timedelta(days=lookback_days)).cast("timestamp_ntz")
    return docs.filter(parse_utc(F.col("updatedAt")) >= start)


def rows_since(df: DataFrame, mark: datetime, lookback_days: int = 0) -> DataFrame:
    """The same filter on a flat table; it reaches the Parquet scan."""
    return df.filter(F.col("updated_at") >= F.lit(mark - timedelta(days=lookback_days)).cast("timestamp_ntz"))


def load_entity(
    store: TableStore,
    table: str,
    docs: DataFrame,
    flatten: Callable[[DataFrame, datetime], DataFrame],
    run_ts: datetime,
    mode: str,
    mark: datetime | None,
    parents: DataFrame | None = None,
    lookback_days: int = 0,
) -> LoadResult:
    """Load one table. Children follow their parents' mark through ``parents``.

    ``parents`` holds the ids of changed parents; without it ``docs`` carry their own
    ``updatedAt``.
    """
    if mode == "incremental" and mark is not None:
        changed = docs.join(parents, "id", "left_semi") if parents is not None else changed_since(docs, mark, lookback_days)
        store.create_if_absent(table)
        rows = flatten(changed, run_ts)
        if parents is not None and table in schemas.BUCKET_KEYS:
            return LoadResult(table, "incremental", store.replace_children(table, rows, parents))
        return LoadResult(table, "incremental", store.upsert(table, rows, schemas.STAGING_KEYS[table]))
    return LoadResult(table, "full", store.load_full(table, flatten(docs, run_ts)))


def load_orders(
    store: TableStore,
    documents: Mapping[str, DataFrame],
    run_ts: datetime,
    mode: str = "auto",
    lookback_days: int = 0,
) -> list[LoadResult]:
    """Load orders and their child tables from documents, one frame per table name.

    Every table has a mark of its own, in terms of the orders' update times, that is committed after its rows are in. A run
    that fails at one table is repeated from the marks: tables before it read again what they have, the others what they
    lack. A child's rows of a changed order replace all rows of that order. Keys are checked after each load; a load that
    fails is recorded as failed and raised.
    """
    parent_docs = documents[PARENT]
    reached = parent_docs.agg(F.max(parse_utc(F.col("updatedAt")))).first()[0]
    results = []
    for table, flatten in ORDER_FLATTENERS.items():
        if table not in documents:
            continue
        chosen = resolve_mode(store, table, mode)
        mark = high_water_mark(store, table) if chosen == "incremental" else None
        changed = None
        if mark is not None and table != PARENT:
            changed = changed_since(parent_docs, mark, lookback_days).select("id").distinct()
        try:
            results.append(load_entity(store, table, documents[table], flatten, run_ts, chosen, mark, changed, lookback_days))
            later = [t for t in (mark, reached) if t is not None]
            commit_mark(store, table, max(later) if later else None, run_ts)
        except Exception:
            record_state(store, [LoadResult(table, chosen, 0)], run_ts, "failed")
            raise
        record_state(store, results[-1:], run_ts, check_keys(store, table))
    return results


ENTITY_FLATTENERS: dict[str, Callable[[DataFrame, datetime], DataFrame]] = {
    "stg_products": fl.flatten_products,
    "stg_product_variants": fl.flatten_variants,
    "stg_customers": fl.flatten_customers,
    "stg_locations": fl.flatten_locations,
    "stg_abandoned_checkouts": fl.flatten_abandoned_checkouts,
}


def load_entities(
    store: TableStore, documents: Mapping[str, DataFrame], run_ts: datetime, mode: str = "auto", lookback_days: int = 0
) -> list[LoadResult]:
    """Load products, variants, customers, locations and checkouts, each by its own mark, and check its keys afterwards.

    A table without an update time is loaded in full. A load that fails is recorded as failed and raised.
    """
    results = []
    for table, docs in documents.items():
        chosen = resolve_mode(store, table, mode)
        dated = "updated_at" in dict(schemas.columns(table))
        mark = high_water_mark(store, table) if chosen == "incremental" and dated else None
        try:
            results.append(load_entity(store, table, docs, ENTITY_FLATTENERS[table], run_ts, chosen, mark, lookback_days=lookback_days))
        except Exception:
            record_state(store, [LoadResult(table, chosen, 0)], run_ts, "failed")
            raise
        record_state(store, results[-1:], run_ts, check_keys(store, table))
    return results


def load_snapshot(store: TableStore, docs: DataFrame, run_ts: datetime, day: Column) -> LoadResult:
    """Load the stock levels of one day; a repeated run replaces that day."""
    table = "stg_inventory_levels"
    rows = store.upsert_partitions(table, fl.flatten_inventory_levels(docs, run_ts, day), "snapshot_date")
    result = LoadResult(table, "snapshot", rows)
    record_state(store, [result], run_ts, check_keys(store, table))
    return result


# --- fixed values: how many entries of an inner list a table takes ----------------
LIST_LIMITS = {"stg_order_line_items": ("lineItems", 100), "stg_inventory_levels": ("inventoryLevels", 20)}


def load_capped(
    store: TableStore, table: str, docs: DataFrame, flatten: Callable[[DataFrame, datetime], DataFrame], run_ts: datetime, limit: int | None = None
) -> LoadResult:
    """Load the first entries of every document's list; what lies beyond goes to ``<table>_overflow``.

    A report tells for each table how many documents had more, how many rows that were, and how many lists the source
    itself had cut.
    """
    connection, usual = LIST_LIMITS[table]
    limit = limit or usual
    kept, rest = fl.cap_list(docs, connection, limit)
    rows = store.load_full(table, flatten(kept, run_ts), dealt=False)  # a later upsert would deal them
    beyond = store.load_full(f"{table}_overflow", flatten(rest, run_ts), dealt=False)
    at_source = F.count(F.when(F.col(f"{connection}.pageInfo.hasNextPage"), 1))
    counted = docs.agg(F.count(F.when(F.size(f"{connection}.edges") > limit, 1)).alias("parents"), at_source.alias("cut_at_source"))
    report = counted.withColumns(
        {"entity": F.lit(table), "list_limit": F.lit(limit), "rows_cut": F.lit(beyond), "updated_at": F.lit(run_ts).cast("timestamp_ntz")}
    )
    store.create_if_absent("truncated_lists")
    store.upsert("truncated_lists", report, ["entity", "list_limit"])
    return LoadResult(table, "capped", rows)


def check_keys(store: TableStore, table: str) -> str:
    """The state after a load: keys of the stored table that occur twice are reported, not repaired."""
    unique = duplicate_keys(store.read(table), schemas.STAGING_KEYS[table]).isEmpty()
    return "success" if unique else "duplicate keys"


def record_state(store: TableStore, results: list[LoadResult], run_ts: datetime, status: str = "success") -> None:
    """Keep one row per entity: last run, status, rows."""
    store.create_if_absent("etl_state")
    entries = pa.table({"entity": [r.table for r in results], "records_processed": [r.rows for r in results]})
    now = F.lit(run_ts).cast("timestamp_ntz")
    state = store.spark.createDataFrame(entries).withColumns(
        {"last_sync_at": now, "last_run_status": F.lit(status), "updated_at": now}
    )
    store.upsert("etl_state", state, ["entity"])
