"""Order documents as a stream: each micro-batch is upserted into staging.

The source watches a folder for new JSON-lines files. A batch carries whole documents, so
no state is kept between batches; keyed upserts and replacement by order make a replayed batch harmless.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind.functions.scalars import parse_utc
from tradewind.operators.flatten import ORDER_FLATTENERS
from tradewind.operators.relational import latest_per_key
from tradewind.sources import documents, schemas
from tradewind.sources.tables import TableStore


def upsert_batch(store: TableStore, docs: DataFrame, run_ts: datetime, tables: Iterable[str]) -> None:
    """Upsert all tables from one batch, whose documents are parsed once."""
    docs = docs.persist()
    try:
        _upsert_tables(store, docs, run_ts, tables)
    finally:
        docs.unpersist()


def _upsert_tables(store: TableStore, docs: DataFrame, run_ts: datetime, tables: Iterable[str]) -> None:
    """Orders and what hangs on their children are upserted by key; children are replaced order by order, so none stays behind."""
    # A document that arrives twice in one batch: the later update wins; a hash settles ties.
    order = [parse_utc(F.col("updatedAt")).desc_nulls_last(), F.xxhash64(*docs.columns)]
    latest = latest_per_key(docs, ["id"], order)
    for table in tables:
        store.create_if_absent(table)
        rows = ORDER_FLATTENERS[table](latest, run_ts)
        if table in schemas.BUCKET_KEYS:
            store.replace_children(table, rows, latest.select("id"))
        else:
            store.upsert(table, rows, schemas.STAGING_KEYS[table])


def stream_orders(
    spark: SparkSession,
    folder: str,
    store: TableStore,
    checkpoint: str,
    tables: Iterable[str] = tuple(ORDER_FLATTENERS),
    files_per_batch: int = 100,
    run_ts: datetime | None = None,
) -> StreamingQuery:
    """Consume what is in the folder now, batch by batch, and stop.

    ``run_ts`` (UTC) stamps the rows of all batches; the time of this call by default.
    """
    stamp = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    tables = tuple(tables)
    docs = (
        spark.readStream.schema(documents.ORDER).option("maxFilesPerTrigger", files_per_batch).json(folder)
    )
    return (
        docs.writeStream.foreachBatch(lambda batch, _: upsert_batch(store, batch, stamp, tables))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
