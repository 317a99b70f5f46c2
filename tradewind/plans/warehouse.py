"""The build graph: staging tables to dimensions, facts and the voucher layer.

A table is built on first use, in dependency order, and written through the table
store; later reads scan the stored Parquet.
"""

from __future__ import annotations

import threading
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.scalars import id_digits
from tradewind.operators.row_index import Numbering, row_index
from tradewind.plans import dimensions as dim
from tradewind.plans import facts as fact
from tradewind.plans import views, vouchers
from tradewind.plans.keys import KeyRegistry
from tradewind.session import scratch_path
from tradewind.sources import adapter, schemas
from tradewind.sources.tables import KEY_BUCKET, TableStore


class StoredStaging(Mapping):
    """Staging frames by name, written to the store the first time each is used; ``placed`` if co-located ones lie by their buckets already."""

    def __init__(self, store: TableStore, frames: Callable[[str], DataFrame], placed: bool = False):
        self.store, self._frames, self._placed = store, frames, placed
        self._locks: dict[str, threading.Lock] = defaultdict(threading.Lock)

    def __getitem__(self, table: str) -> DataFrame:
        with self._locks[table]:
            if not self.store.exists(table):
                placed = self._placed and table in CO_LOCATED
                with joined_in_place(self.store.spark, self.store.buckets) if placed else nullcontext():
                    self.store.load_full(table, self._frames(table), partition_by=PARTITIONS.get(table), co_locate=CO_LOCATED.get(table), dealt=False, placed=placed)
        return self.store.read(table)

    def co_located(self, table: str) -> DataFrame:
        """The table with the column it is kept in buckets of."""
        self[table]
        return self.store.read(table, hidden=[CO_LOCATED[table][0]])

    def __iter__(self):
        return iter(schemas.STAGING)

    def __len__(self):
        return len(schemas.STAGING)


ALL_KEYS, WIDTH = "spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.shuffle.partitions"
_joining: Counter = Counter()
_joining_lock = threading.Lock()
_own: dict[int, dict[str, str]] = {}


@contextmanager
def joined_in_place(spark: SparkSession, buckets: int) -> Iterator[None]:
    """Rows in buckets of a join key stay there, also in a join on several keys: the other side is dealt into as many parts.

    The settings are the session's own again when the last of the builds that run at once has ended.
    """
    session = id(spark)
    with _joining_lock:
        if not _joining[session]:
            _own[session] = {key: spark.conf.get(key) for key in (ALL_KEYS, WIDTH)}
            spark.conf.set(ALL_KEYS, "false")
            spark.conf.set(WIDTH, str(buckets))
        _joining[session] += 1
    try:
        yield
    finally:
        with _joining_lock:
            _joining[session] -= 1
            if not _joining[session]:
                for key, value in _own.pop(session).items():
                    spark.conf.set(key, value)


class Warehouse(Mapping):
    """Warehouse tables by name.

    ``as_of`` stands for "today" in every relative measure; ``calendar`` bounds the
    date dimension (facts outside it are left out by the enriched views). With ``stable_keys`` numbers come from a
    registry in the store, so that a row keeps its key whatever is built later. A ``maintained`` warehouse has such keys
    and keeps the facts of orders in partitions by order, so that ``maintain`` writes few of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        staging: Mapping[str, DataFrame],
        store: TableStore,
        as_of: date,
        calendar: tuple[date, date] = (dim.CALENDAR_START, dim.CALENDAR_END),
        fiscal_start_month: int = 1,
        commission_rates: Callable[[], DataFrame] | None = None,
        base: Mapping[str, DataFrame] | None = None,
        stable_keys: bool = False,
        maintained: bool = False,
    ):
        self.spark, self.stg, self.store = spark, staging, store
        self.as_of, self.calendar, self.fiscal_start_month = as_of, calendar, fiscal_start_month
        self.commission_rates = commission_rates
        self.base = {} if base is None else base
        self.number: Numbering = KeyRegistry(store).number if stable_keys or maintained else row_index
        self.maintained = maintained
        self.document_paths: dict[str, str] = {}
        self.loaded_at = F.current_timestamp().cast("timestamp_ntz")
        self._locks: dict[str, threading.Lock] = defaultdict(threading.Lock)

    def __getitem__(self, table: str) -> DataFrame:
        with self._locks[table]:  # a table asked for twice at once is built once
            if not self.store.exists(table):
                self._build(table)
        return self.store.read(table)

    def children(self, table: str) -> DataFrame:
        """The staged orders or children of theirs, with their buckets where the staging store keeps them."""
        return self.stg.co_located(table) if isinstance(self.stg, StoredStaging) else self.stg[table]

    def _build(self, table: str) -> None:
        needed = NEEDS.get(table, ())
        with ThreadPoolExecutor(max(len(needed), 1)) as pool:
            list(pool.map(lambda name: (self.stg if name in schemas.STAGING else self)[name], needed))
        frame = BUILDS[table](self)
        if self.maintained and table in schemas.BUCKET_KEYS:
            dealt = (KEY_BUCKET, self.store.bucket_of(table))
            self.store.load_full(table, frame, partition_by=dealt, sort_by=FILE_ORDER.get(table, ()))
            return
        placed = table in IN_PLACE and isinstance(self.stg, StoredStaging) and self.stg.store.buckets == self.store.buckets
        with joined_in_place(self.spark, self.store.buckets) if placed else nullcontext():
            self.store.load_full(
                table, frame, partition_by=PARTITIONS.get(table), sort_by=FILE_ORDER.get(table, ()), co_locate=CO_LOCATED.get(table), placed=placed
            )

    def __iter__(self):
        return iter(BUILDS)

    def __len__(self):
        return len(BUILDS)

    def prepare(self, tables: Iterable[str] | None = None, at_once: int = 4) -> None:
        """Build tables that are missing, independent ones side by side.

        Each build submits its own Spark jobs; a fact waits for the dimensions it reads.
        """
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(self.__getitem__, tables or BUILDS))

    def rebuild(self) -> None:
        """Build every table again, dimensions before facts, each into a new version."""
        for table in BUILDS:
            self._build(table)


BUILDS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "dim_date": lambda w: dim.dim_date(w.spark, *w.calendar, w.fiscal_start_month),
    "dim_time": lambda w: dim.dim_time(w.spark),
    "dim_product": lambda w: dim.dim_product(w.stg["stg_products"], w.stg["stg_product_variants"], w.loaded_at, w.number),
    "dim_customer": lambda w: dim.dim_customer(w.stg["stg_customers"], w.stg["stg_orders"], w.as_of, w.loaded_at, w.number),
    "dim_geography": lambda w: dim.dim_geography(w.stg["stg_orders"], w.loaded_at, w.number),
    "dim_discount": lambda w: dim.dim_discount(w.stg["stg_discount_codes"], w.loaded_at, w.number),
    "dim_location": lambda w: dim.dim_location(w.stg["stg_locations"], w.loaded_at, w.number),
    "fact_order": lambda w: fact.fact_order(w.stg, w, w.loaded_at, w.number),
    "fact_order_line_item": lambda w: fact.fact_order_line_item(
        w.children("stg_order_line_items"), w["fact_order"], w["dim_product"], w.loaded_at, w.number
    ),
    "fact_fulfillment": lambda w: fact.fact_fulfillment(
        w.children("stg_fulfillments"), w.stg["stg_fulfillment_line_items"], w["fact_order"], w["dim_location"], w.loaded_at, w.number
    ),
    "fact_refund": lambda w: fact.fact_refund(
        w.children("stg_refunds"), w.stg["stg_refund_line_items"], w["fact_order"], w.loaded_at, w.number
    ),
    "fact_inventory_snapshot": lambda w: fact.fact_inventory_snapshot(
        w.stg["stg_inventory_levels"], w.stg["stg_product_variants"], w["dim_product"], w["dim_location"], w.loaded_at
    ),
    "agg_product_day": lambda w: views.product_days(w),
    "dim_channel": lambda w: vouchers.dim_channel(w.stg["stg_channels"], w.loaded_at),
    "ref_commission_rate": lambda w: vouchers.ref_commission_rate(w.commission_rates(), w["dim_channel"], w.loaded_at),
    "dim_voucher": lambda w: vouchers.dim_voucher(w.stg, w, w.loaded_at),
    "fact_voucher_lifecycle": lambda w: vouchers.fact_voucher_lifecycle(w.stg, w, w.as_of, w.loaded_at),
    "fact_channel_daily": lambda w: vouchers.fact_channel_daily(
        w["fact_voucher_lifecycle"], w["dim_channel"], w.loaded_at
    ),
}

# Inputs that do not depend on each other and are made ready side by side. Waiting on a
# table that another thread builds cannot deadlock: the graph has no cycles.
NEEDS = {
    "dim_product": ("stg_products", "stg_product_variants"),
    "dim_customer": ("stg_customers", "stg_orders"),
    "fact_order": (
        "dim_customer",
        "dim_geography",
        "dim_discount",
        "stg_order_line_items",
        "stg_order_transactions",
        "stg_order_tax_lines",
        "stg_order_shipping_lines",
    ),
    "fact_order_line_item": ("fact_order", "dim_product"),
    "fact_fulfillment": ("fact_order", "dim_location", "stg_fulfillments", "stg_fulfillment_line_items"),
    "agg_product_day": ("fact_order_line_item", "dim_date"),
    "fact_refund": ("fact_order", "stg_refunds", "stg_refund_line_items"),
    "fact_inventory_snapshot": ("dim_product", "dim_location", "stg_inventory_levels"),
    "dim_voucher": ("dim_channel", "dim_discount", "stg_orders", "stg_gift_cards"),
    "fact_voucher_lifecycle": ("dim_voucher", "fact_order_line_item"),
}

# Columns that reports filter on, kept in order inside each file.
FILE_ORDER = {
    "fact_order": ("order_date_key",),
    "fact_order_line_item": ("order_date_key",),
    "fact_fulfillment": ("fulfillment_date_key",),
    "fact_refund": ("refund_date_key",),
    "fact_inventory_snapshot": ("snapshot_date",),
    "agg_product_day": ("order_date_key",),
    "fact_voucher_lifecycle": ("creation_date_key",),
    "fact_channel_daily": ("date_key",),
}

# Columns that tables are dealt by into folders, so that a filter on them lists those folders only.
PARTITIONS = {"stg_inventory_levels": "snapshot_date", "fact_inventory_snapshot": "snapshot_date"}

# Tables kept in the same number of buckets of the order number, so that they join on it without a shuffle.
CO_LOCATED = {
    "fact_order": ("order_id", lambda: F.col("order_id")),
    "stg_orders": (fact.ORDER_NUMBER[0], lambda: id_digits(F.col("id"))),
    "stg_order_line_items": fact.ORDER_NUMBER,
    "stg_fulfillments": fact.ORDER_NUMBER,
    "stg_refunds": fact.ORDER_NUMBER,
}

# Facts whose wide rows are made in the buckets that staged rows lie in.
IN_PLACE = ("fact_order", "fact_order_line_item", "fact_fulfillment", "fact_refund")

LINES_PER_BUCKET = 500_000


def buckets_for(lines: int) -> int:
    """Buckets for the orders and their children: as many as keep what one task sorts and joins the same at any size, eight at least."""
    return max(8, -(-lines // LINES_PER_BUCKET))


# --- the generated tables as a warehouse -----------------------------------------
# fixed values: their orders run from 1995 to 2001
TEST_AS_OF = date(2001, 12, 31)
TEST_CALENDAR = (date(1995, 1, 1), date(2002, 12, 31))

_open: dict[tuple[str, str], Warehouse] = {}


def open_generated(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over the generated tables in ``folder``, one per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        base = adapter.BaseTables(spark, folder)
        store = TableStore(spark, scratch_path(spark, "warehouse"), lambda: buckets_for(base["lineitem"].count()))

        def deal(rows: DataFrame, order: Column) -> DataFrame:
            return rows.repartition(store.buckets, order)

        staging = StoredStaging(store, lambda table: adapter.BUILDERS[table](base, *([deal] if table in CO_LOCATED else [])), placed=True)
        _open[key] = Warehouse(
            spark,
            staging,
            store,
            as_of=TEST_AS_OF,
            calendar=TEST_CALENDAR,
            commission_rates=lambda: adapter.commission_rates(base),
            base=base,
        )
    return _open[key]
