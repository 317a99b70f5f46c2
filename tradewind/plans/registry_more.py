"""Registered queries for sessions, capped lists and registered keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators import flatten as fl
from tradewind.operators.sessions import conversion_by_day, sessions
from tradewind.plans import dimensions, loads
from tradewind.plans.keys import KeyRegistry
from tradewind.plans.registry import register
from tradewind.plans.registry_loads import ROLES, RUN_TS, docs, shown_of, with_addresses
from tradewind.plans.warehouse import Warehouse
from tradewind.session import scratch_path
from tradewind.sources import generated_documents as gen
from tradewind.sources.bulk import child_documents, order_documents, orphans, read_lines
from tradewind.sources.documents import PACKED
from tradewind.sources.tables import TableStore

# --- sessions over events ----------------------------------------------------------
register(
    "ev01_sessions",
    lambda w: sessions(w.base["events"]),
    "user_id:i session_start:t session_end:t events:i conversions:i converted:b value:m",
)
register(
    "ev02_conversion_by_day",
    lambda w: conversion_by_day(sessions(w.base["events"])),
    "day:d sessions:i converting_sessions:i value:m conversion_rate:r",
)

# --- bulk exports (SC2) -----------------------------------------------------------------
def bulk(w: Warehouse) -> DataFrame:
    """The lines of a bulk export of the generated orders, written once."""
    if "bulk" not in w.document_paths:
        path = f"{w.store.root}/documents/bulk"
        gen.bulk_lines(w.base, w.stg).write.options(**PACKED).text(path)
        w.document_paths["bulk"] = path
    return read_lines(w.spark, w.document_paths["bulk"])


_BULK = (
    ("stg_orders", "orders", fl.flatten_orders),
    ("stg_order_line_items", "lines", fl.flatten_line_items),
    ("stg_order_transactions", "orders", fl.flatten_transactions),
    ("stg_order_tax_lines", "orders", fl.flatten_tax_lines),
    ("stg_order_discount_applications", "discounts", fl.flatten_discount_applications),
    ("stg_order_shipping_lines", "shipping", fl.flatten_shipping_lines),
    ("stg_fulfillments", "orders", fl.flatten_fulfillments),
    ("stg_fulfillment_line_items", "fulfillment_lines", fl.flatten_fulfillment_line_items),
    ("stg_refunds", "orders", fl.flatten_refunds),
    ("stg_refund_line_items", "refund_lines", fl.flatten_refund_line_items),
)


def flattened(w: Warehouse, table: str, page: str, flattener) -> DataFrame:
    lines = bulk(w)
    pages = order_documents(lines) if page == "orders" else child_documents(lines, page)
    return with_addresses(flattener(pages, RUN_TS), **ROLES.get(table, {}))


for number, (table, page, flattener) in enumerate(_BULK, start=1):
    register(f"bx{number:02d}_{table[4:]}", lambda w, t=table, p=page, f=flattener: flattened(w, t, p, f), shown_of(table))
# lines, discounts and refunds of orders that are missing from the header point to nothing
register("bx11_orphans", lambda w: orphans(bulk(w)).groupBy("page").agg(F.count(F.lit(1)).alias("parents"), F.sum("lines").alias("lines")), "page:s parents:i lines:i")

# --- capped lists (SC18) --------------------------------------------------------------
SHORT = 3  # generated orders have seven lines at most


def capped(w: Warehouse, limit: int | None = None) -> TableStore:
    """Lines loaded from documents of whole orders, under the usual limit or a shorter one."""
    store = TableStore(w.spark, scratch_path(w.spark, "capped"))
    loads.load_capped(store, "stg_order_line_items", docs(w, "line_lists"), fl.flatten_line_items, RUN_TS, limit)
    return store


register("sc18_kept_lines", lambda w: capped(w, SHORT).read("stg_order_line_items"), "id:s order_id:s sku:s quantity:i")
register("sc18_overflow_lines", lambda w: capped(w, SHORT).read("stg_order_line_items_overflow"), "id:s order_id:s sku:s quantity:i")


def truncation_report(w: Warehouse) -> DataFrame:
    """The report under the usual limit and under the short one."""
    return capped(w).read("truncated_lists").unionByName(capped(w, SHORT).read("truncated_lists"))


register("sc18_truncation_report", truncation_report, "entity:s list_limit:i parents:i rows_cut:i cut_at_source:i")


# --- keys that stay (TF9, WN1) ----------------------------------------------------------
def registered_products(w: Warehouse) -> DataFrame:
    """The product dimension built without every seventh variant, then with all of them."""
    store = TableStore(w.spark, scratch_path(w.spark, "keys"))
    number = KeyRegistry(store).number
    variants = w.stg["stg_product_variants"]
    digits = F.regexp_extract("id", "[0-9]+$", 0).cast("bigint")
    for part in (variants.filter(digits % 7 != 3), variants):
        built = dimensions.dim_product(w.stg["stg_products"], part, w.loaded_at, number)
    return built


register("tf09_registered_keys", registered_products, "product_key:i variant_id:s product_id:s")
