"""Registered queries for scans, documents, loads and scalar functions."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import scalars as sf
from tradewind.operators import flatten as fl
from tradewind.operators.addresses import FIELDS, address_digest, address_key, parse_addresses
from tradewind.operators.relational import (
    completeness,
    duplicate_keys,
    labelled_counts,
    latest_per_key,
    ordinal_pivot,
)
from tradewind.operators.row_index import row_index, tile_index
from tradewind.plans import loads
from tradewind.plans.contract import of_table
from tradewind.plans.registry import register
from tradewind.plans.warehouse import Warehouse
from tradewind.session import scratch_path
from tradewind.sources import documents, schemas
from tradewind.sources import generated_documents as gen
from tradewind.sources.adapter import SNAPSHOTS
from tradewind.sources.tables import TableStore

RUN_TS = datetime(2001, 12, 31)

# Document page -> (builder, declared shape)
PAGES = {
    "orders": (gen.order_documents, "order"),
    "lines": (gen.line_documents, "order"),
    "line_lists": (gen.line_list_documents, "order"),
    "fulfillments": (gen.fulfillment_documents, "order"),
    "fulfillment_lines": (gen.fulfillment_line_documents, "order"),
    "refunds": (gen.refund_documents, "order"),
    "refund_lines": (gen.refund_line_documents, "order"),
    "customers": (gen.customer_documents, "customer"),
    "products": (gen.product_documents, "product"),
    "variants": (gen.variant_documents, "variant"),
    "locations": (gen.location_documents, "location"),
    "checkouts": (gen.checkout_documents, "checkout"),
    **{
        f"inventory_{day}": ((lambda src, stg, d=day: gen.inventory_documents(src, stg, d)), "inventory_item")
        for day in SNAPSHOTS
    },
}


def docs(w: Warehouse, page: str) -> DataFrame:
    """The documents of one kind, written as JSON lines once and scanned from there."""
    build, shape = PAGES[page]
    if page not in w.document_paths:
        path = f"{w.store.root}/documents/{page}"
        build(w.base, w.stg).write.options(**documents.PACKED).json(path)
        w.document_paths[page] = path
    return documents.read_documents(w.spark, w.document_paths[page], shape)


# --- typed staging scans (SC1) -----------------------------------------------------
HIDDEN = ("extracted_at", "shipping_address_json", "billing_address_json", "default_address_json")


def with_addresses(df: DataFrame, **roles: str) -> DataFrame:
    """Show address JSON as parsed columns, so that results compare by value."""
    for prefix, column in roles.items():
        df = parse_addresses(df, column, f"{prefix}_")
    return df


ROLES = {
    "stg_orders": {"ship": "shipping_address_json", "bill": "billing_address_json"},
    "stg_customers": {"home": "default_address_json"},
}


def shown_of(table: str):
    extra = [
        (f"{prefix}_{part}", "s")
        for prefix in ROLES.get(table, {})
        for part in (FIELDS if prefix != "home" else ("city", "country", "postal_code"))
    ]
    return of_table(table, HIDDEN) + extra


# The stored scan of the two tables without a document loader, and of the largest two.
for number, table in ((17, "stg_discount_codes"), (18, "stg_gift_cards")):
    register(f"fl{number}_{table[4:]}", lambda w, t=table: w.stg[t], of_table(table, HIDDEN))
register("sc01_scan_orders", lambda w: with_addresses(w.stg["stg_orders"], **ROLES["stg_orders"]), shown_of("stg_orders"))
register("sc01_scan_line_items", lambda w: w.stg["stg_order_line_items"], shown_of("stg_order_line_items"))
for table in schemas.STAGING:
    if table not in ("stg_orders", "stg_order_line_items", "stg_discount_codes", "stg_gift_cards"):
        register(f"sc01_scan_{table[4:]}", lambda w, t=table: with_addresses(w.stg[t], **ROLES.get(t, {})), shown_of(table))

# --- flatteners (FL1-FL16) -----------------------------------------------------------
_FLATTENED = (
    ("fl01", "stg_orders", "orders", fl.flatten_orders),
    ("fl02", "stg_order_line_items", "lines", fl.flatten_line_items),
    ("fl03", "stg_order_transactions", "orders", fl.flatten_transactions),
    ("fl04", "stg_order_tax_lines", "orders", fl.flatten_tax_lines),
    ("fl05", "stg_order_discount_applications", "orders", fl.flatten_discount_applications),
    ("fl06", "stg_order_shipping_lines", "orders", fl.flatten_shipping_lines),
    ("fl07", "stg_fulfillments", "fulfillments", fl.flatten_fulfillments),
    ("fl08", "stg_fulfillment_line_items", "fulfillment_lines", fl.flatten_fulfillment_line_items),
    ("fl09", "stg_refunds", "refunds", fl.flatten_refunds),
    ("fl10", "stg_refund_line_items", "refund_lines", fl.flatten_refund_line_items),
    ("fl11", "stg_customers", "customers", fl.flatten_customers),
    ("fl12", "stg_products", "products", fl.flatten_products),
    ("fl13", "stg_product_variants", "variants", fl.flatten_variants),
    ("fl14", "stg_locations", "locations", fl.flatten_locations),
    ("fl16", "stg_abandoned_checkouts", "checkouts", fl.flatten_abandoned_checkouts),
)
for key, table, page, flattener in _FLATTENED:
    register(
        f"{key}_{table[4:]}",
        lambda w, t=table, p=page, f=flattener: with_addresses(f(docs(w, p), RUN_TS), **ROLES.get(t, {})),
        shown_of(table),
    )


def inventory_levels(w: Warehouse) -> DataFrame:
    days = [fl.flatten_inventory_levels(docs(w, f"inventory_{d}"), RUN_TS, F.lit(d).cast("date")) for d in SNAPSHOTS]
    return reduce(DataFrame.unionByName, days)


register("fl15_inventory_levels", inventory_levels, shown_of("stg_inventory_levels"))
register(
    "sc18_oversized_documents",
    lambda w: fl.oversized(docs(w, "orders"), "discountApplications", 1),
    "oversized_parents:i",
)


# --- loads (SC5, SC8-SC10, SC12, SC16, IN1-IN5, JN14, CF11, TF13) ------------------------
SPLIT = datetime(1999, 1, 1)


def _fresh_store(w: Warehouse) -> TableStore:
    return TableStore(w.spark, scratch_path(w.spark, "load"))


def incremental_orders(w: Warehouse) -> DataFrame:
    """Orders up to a day loaded in full, the rest by two runs of the incremental mode."""
    store = _fresh_store(w)
    pages = docs(w, "orders")
    early = pages.filter(sf.parse_utc(F.col("updatedAt")) < F.lit(SPLIT))
    loads.load_orders(store, {"stg_orders": early}, RUN_TS, "full")
    for _ in range(2):
        loads.load_orders(store, {"stg_orders": pages}, RUN_TS, "auto")
    return with_addresses(store.read("stg_orders"), **ROLES["stg_orders"])


def incremental_children(w: Warehouse) -> DataFrame:
    """Payments follow the mark their orders had before the run."""
    store = _fresh_store(w)
    pages = docs(w, "orders")
    early = pages.filter(sf.parse_utc(F.col("updatedAt")) < F.lit(SPLIT))
    for part in (early, pages):
        loads.load_orders(store, {"stg_orders": part, "stg_order_transactions": part}, RUN_TS, "auto")
    return store.read("stg_order_transactions")


def load_state(w: Warehouse) -> DataFrame:
    store = _fresh_store(w)
    pages = docs(w, "orders")
    tables = ("stg_orders", "stg_order_tax_lines")
    loads.load_orders(store, {t: pages for t in tables}, RUN_TS, "full")
    return store.read("etl_state")


def snapshot_appends(w: Warehouse) -> DataFrame:
    """All snapshot days, the last loaded twice."""
    store = _fresh_store(w)
    levels = w.stg["stg_inventory_levels"]
    for day in (*SNAPSHOTS, SNAPSHOTS[-1]):
        store.upsert_partitions(
            "stg_inventory_levels", levels.filter(F.col("snapshot_date") == F.lit(day).cast("date")), "snapshot_date"
        )
    return store.read("stg_inventory_levels")


def keyed_upsert(w: Warehouse) -> DataFrame:
    """Raise the price of every third variant through an upsert with repeated keys."""
    store = _fresh_store(w)
    variants = w.stg["stg_product_variants"]
    store.load_full("stg_product_variants", variants)
    digits = sf.id_digits(F.col("id")).cast("bigint")
    changed = variants.filter(digits % 3 == 0)
    later = F.col("updated_at") + F.make_dt_interval(days=F.lit(1))
    raised = changed.withColumns({"price": F.col("price") + 1, "updated_at": later})
    store.upsert("stg_product_variants", raised.unionByName(changed))
    return store.read("stg_product_variants")


ENTITY_PAGES = {
    "stg_products": "products",
    "stg_product_variants": "variants",
    "stg_customers": "customers",
    "stg_locations": "locations",
    "stg_abandoned_checkouts": "checkouts",
}


def loaded_entity(w: Warehouse, table: str) -> DataFrame:
    """Loaded in full, then again by its mark, from the same documents; as stored afterwards."""
    store = _fresh_store(w)
    for _ in range(2):
        loads.load_entities(store, {table: docs(w, ENTITY_PAGES[table])}, RUN_TS)
    return with_addresses(store.read(table), **ROLES.get(table, {}))


def loaded_snapshots(w: Warehouse) -> DataFrame:
    """Every day's documents, the last day's twice; as stored afterwards."""
    store = _fresh_store(w)
    for day in (*SNAPSHOTS, SNAPSHOTS[-1]):
        loads.load_snapshot(store, docs(w, f"inventory_{day}"), RUN_TS, F.lit(day).cast("date"))
    return store.read("stg_inventory_levels")


for table in ENTITY_PAGES:
    register(f"in01_load_{table[4:]}", lambda w, t=table: loaded_entity(w, t), shown_of(table))
register("in01_load_inventory_levels", loaded_snapshots, shown_of("stg_inventory_levels"))


def since_stored_mark(w: Warehouse, lookback_days: int = 0) -> DataFrame:
    """Orders that a run would read again after one that saw the orders up to a day."""
    store, orders = _fresh_store(w), w.stg["stg_orders"]
    store.load_full("stg_orders", orders.filter(F.col("updated_at") < F.lit(SPLIT).cast("timestamp_ntz")))
    return loads.rows_since(orders, loads.high_water_mark(store), lookback_days)


register("in04_incremental_orders", incremental_orders, shown_of("stg_orders"))
register("in03_incremental_children", incremental_children, shown_of("stg_order_transactions"))
register("sc09_keyed_upsert", keyed_upsert, shown_of("stg_product_variants"))
register("sc16_snapshot_appends", snapshot_appends, shown_of("stg_inventory_levels"))
register("tf13_load_state", load_state, "entity:s last_sync_at:t last_run_status:s records_processed:i")
register(
    "in02_high_water_window",
    lambda w: since_stored_mark(w).agg(
        F.count(F.lit(1)).alias("orders"), F.min("updated_at").alias("first_change"), F.max("updated_at").alias("mark")
    ),
    "orders:i first_change:t mark:t",
)
register(
    "cf11_lookback_window",
    lambda w: since_stored_mark(w, lookback_days=3).agg(
        F.count(F.lit(1)).alias("orders"), F.min("updated_at").alias("first_change")
    ),
    "orders:i first_change:t",
)
register(
    "in05_duplicate_keys",
    lambda w: duplicate_keys(w.stg["stg_order_line_items"], ["order_id", "sku"]),
    "order_id:s sku:s row_count:i",
)
register(
    "sc10_row_counts",
    lambda w: labelled_counts({t: w.stg[t] for t in schemas.STAGING}, "table_name", "row_count"),
    "table_name:s row_count:i",
)
register(
    "ag19_completeness",
    lambda w: completeness(
        w.stg["stg_orders"], ["email", "customer_id", "tags", "cancelled_at", "closed_at", "total_refunded", "source_name"]
    ),
    "row_count:i email_filled:i customer_id_filled:i tags_filled:i cancelled_at_filled:i closed_at_filled:i "
    "total_refunded_filled:i source_name_filled:i",
)


def load_summary(w: Warehouse) -> DataFrame:
    lines = w.stg["stg_order_line_items"]
    # Two distinct counts: one by regrouping per order, one by its own pruned scan.
    per_order = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units"), F.sum("discounted_total").alias("net")
    )
    return per_order.agg(
        F.sum("n").alias("lines"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("units").alias("units"),
        F.sum("net").alias("net"),
    ).withColumn("products", lines.agg(F.countDistinct("product_id")).scalar())


register("ag20_load_summary", load_summary, "lines:i orders:i products:i units:i net:m")
register(
    "ol2_latest_products",
    lambda w: w.stg["stg_products"].orderBy(F.desc("created_at"), "id").limit(5),
    "id:s title:s status:s vendor:s",
)
register(
    "ol3_locations_by_name",
    lambda w: w.stg["stg_locations"].orderBy("name").select("name", "city", "country_code", "is_active"),
    "name:s city:s country_code:s is_active:b",
)

# --- windows over whole tables (WN1-WN3) and pivots (AG2-AG5) ----------------------------
register(
    "wn1_line_numbers",
    lambda w: row_index(w.stg["stg_order_line_items"].select("id"), [F.col("id")], "line_item_key"),
    "id:s line_item_key:i",
)
register(
    "wn2_latest_order_per_customer",
    lambda w: latest_per_key(
        w.stg["stg_orders"].filter("customer_id is not null").select("customer_id", "created_at", "id"),
        ["customer_id"],
        [F.desc("created_at"), F.col("id")],
    ),
    "customer_id:s created_at:t id:s",
)
register(
    "wn3_order_value_tiles",
    lambda w: tile_index(
        w.stg["stg_orders"].select("id", "total_price"), [F.col("total_price"), F.col("id")], 5, "tile"
    ),
    "id:s total_price:m tile:i",
)
register(
    "ag2_payment_pivot",
    lambda w: ordinal_pivot(
        w.stg["stg_order_transactions"].filter("status = 'SUCCESS'"),
        "order_id",
        [F.col("created_at"), F.col("id")],
        2,
        {"gateway": "gateway_{}", "amount": "amount_{}"},
    ),
    "order_id:s gateway_1:s amount_1:m gateway_2:s amount_2:m",
)


# --- scalar functions (SF1-SF33, TF1-TF10) --------------------------------------------
def text_functions(w: Warehouse) -> DataFrame:
    tags = F.col("tags")
    return parse_addresses(w.stg["stg_orders"], "shipping_address_json").select(
        sf.id_digits(F.col("id")).alias("digits"),
        sf.id_tail(F.col("id")).alias("tail"),
        "city",
        address_key().alias("address_key"),
        address_digest().alias("address_digest"),
        F.upper("source_name").alias("channel"),
        sf.first_match(tags, {"VIP": "vip", "B2B": "business"}, F.lit("plain")).alias("tag_class"),
        sf.one_of(F.col("financial_status"), ("PAID", "PARTIALLY_REFUNDED")).alias("paid"),
        sf.flag(tags.contains("GIFT")).alias("gift"),
        sf.null_if_blank(F.coalesce(F.col("note"), F.lit("  "))).alias("note"),
        sf.join_array(F.split(tags, ","), "; ").alias("tag_list"),
    )


def number_functions(w: Warehouse) -> DataFrame:
    variants = w.stg["stg_product_variants"]
    price, compare = F.col("price"), F.col("compare_at_price")
    n = sf.id_digits(F.col("id")).cast("int")
    return variants.select(
        "id",
        sf.percent_of(compare - price, compare).cast("decimal(6,2)").alias("discount_percent"),
        sf.ratio(F.col("cost"), price, 100).alias("cost_share"),
        sf.weight_in_grams(F.col("weight"), F.col("weight_unit")).cast("decimal(12,2)").alias("grams"),
        F.coalesce(F.col("cost"), F.lit(0)).alias("cost_or_zero"),
        F.nullif(n % 4, F.lit(0)).alias("remainder"),
        F.ceil(n / F.lit(3.0)).alias("third"),
        F.round(price / 7, 2).alias("weekly"),
    )


def date_functions(w: Warehouse) -> DataFrame:
    made, changed = F.col("created_at"), F.col("updated_at")
    elapsed = sf.micros_between(F.col("processed_at"), made)
    return w.stg["stg_orders"].select(
        "id",
        sf.date_key(made).alias("day_key"),
        F.hour(made).alias("hour_key"),
        F.quarter(made).alias("quarter"),
        F.weekofyear(made).alias("week"),
        (F.weekday(made) + 1).alias("weekday"),
        F.date_format(made, "MMMM").alias("month_name"),
        F.date_format(made, "EEEE").alias("day_name"),
        (F.last_day(made) == made.cast("date")).alias("month_end"),
        F.date_add(made.cast("date"), 30).alias("due"),
        sf.days_between(changed, made).alias("days_to_change"),
        (elapsed.cast("double") / F.lit(3.6e9)).alias("hours_to_process"),
        sf.flag(made >= F.lit(SPLIT)).alias("recent"),
        (F.hour(made).between(9, 16)).alias("business_hours"),
    )


register(
    "sf_text_functions",
    text_functions,
    "digits:s tail:s city:s address_key:s address_digest:s channel:s tag_class:s paid:b gift:b note:s tag_list:s",
)
register(
    "sf_number_functions",
    number_functions,
    "id:s discount_percent:m cost_share:r grams:m cost_or_zero:m remainder:i third:i weekly:m",
)
register(
    "sf_date_functions",
    date_functions,
    "id:s day_key:i hour_key:i quarter:i week:i weekday:i month_name:s day_name:s month_end:b due:d days_to_change:i "
    "hours_to_process:r recent:b business_hours:b",
)

# fixed values: names of discount kinds
DISCOUNT_KINDS = {
    "DiscountCodeBasic": "basic",
    "DiscountCodeBxgy": "bxgy",
    "DiscountCodeFreeShipping": "free_shipping",
    "DiscountCodeApp": "app",
}


def transform_rules(w: Warehouse) -> DataFrame:
    """Document-side rules: money with a default, nested sum, list text, state predicates."""
    order = docs(w, "orders")
    tags = F.col("tags")
    return order.select(
        "id",
        fl.amount_or_zero(F.col("totalRefundedSet")).alias("refunded"),
        fl.amount_or_zero(F.col("totalPriceSet"), "presentmentMoney").alias("presented"),
        fl.sum_amounts(F.col("taxLines"), "priceSet").alias("tax_total"),
        sf.join_array(tags, "|").alias("tag_text"),
        F.col("cancelledAt").isNotNull().alias("is_cancelled"),
        sf.flag(F.col("displayFulfillmentStatus") == "FULFILLED").alias("is_order_fulfilled"),
        sf.flag(F.col("displayFulfillmentStatus") == "PARTIALLY_FULFILLED").alias("is_partially_fulfilled"),
        sf.date_key(sf.parse_utc(F.col("createdAt"))).alias("date_key"),
        F.hour(sf.parse_utc(F.col("createdAt"))).alias("time_key"),
    )


def discount_kinds(w: Warehouse) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in DISCOUNT_KINDS.items() for x in pair])
    return (
        w.stg["stg_discount_codes"]
        .select(F.coalesce(names[F.col("discount_type")], F.lit("unknown")).alias("kind"))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("codes"))
    )


def hash_keys(w: Warehouse) -> DataFrame:
    """Keys that need no order: distinct hashes must equal distinct ids."""
    keyed = w.stg["stg_order_line_items"].select(F.xxhash64(F.lit("line_item"), "id").alias("k"))
    per_key = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"))


def by_currency(w: Warehouse) -> DataFrame:
    return w["fact_order"].groupBy("currency_code").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue")
    )


def defaulted(w: Warehouse) -> DataFrame:
    """Field defaults: listed measures become zero, everything else keeps NULL."""
    return w.stg["stg_orders"].select("id", "total_refunded", "total_discounts", "tags", "cancel_reason").na.fill(
        {"total_refunded": 0, "total_discounts": 0}
    )


def discount_types(w: Warehouse) -> DataFrame:
    """Type told by which value is present, the alternative to reading the type name."""
    kind = F.when(F.col("value_percentage").isNotNull(), "percentage").when(F.col("value_amount").isNotNull(), "fixed")
    return (
        w.stg["stg_order_discount_applications"]
        .groupBy(kind.alias("kind"), "discount_type")
        .agg(F.count(F.lit(1)).alias("applications"))
    )


register(
    "tf_document_rules",
    transform_rules,
    "id:s refunded:m presented:m tax_total:m tag_text:s is_cancelled:b is_order_fulfilled:b is_partially_fulfilled:b "
    "date_key:i time_key:i",
)
register("tf07_field_defaults", defaulted, "id:s total_refunded:m total_discounts:m tags:s cancel_reason:s")
register("tf08_discount_kinds", discount_kinds, "kind:s codes:i")
register("tf09_hash_keys", hash_keys, "rows:i keys:i")
register("tf12_by_currency", by_currency, "currency_code:s orders:i revenue:m")
register("tf14_discount_types", discount_types, "kind:s discount_type:s applications:i")
