"""Documents to staging rows.

Every flattener takes documents and the run's timestamp and returns a frame aligned to
its staging table: 0..n rows per document, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import join_array, parse_utc
from tradewind.operators.relational import align

RunTime = Column | datetime

# fixed values: the inventory states that are kept, and the source's page sizes
QUANTITY_NAMES = ("available", "on_hand", "committed", "incoming", "reserved")
LINES_PER_PAGE, LEVELS_PER_PAGE = 100, 20


# --- shared column forms --------------------------------------------------------
def nodes(connection: Column) -> Column:
    """The nodes of an ``edges``/``node`` connection; an empty array for NULL."""
    return F.transform(F.coalesce(connection["edges"], F.array()), lambda edge: edge["node"])


def amount(money: Column, side: str = "shopMoney") -> Column:
    """The amount of a money bag, NULL when absent or unreadable."""
    return money[side]["amount"].try_cast("decimal(18,2)")


def amount_or_zero(money: Column, side: str = "shopMoney") -> Column:
    return F.coalesce(amount(money, side), F.lit(0).cast("decimal(18,2)"))


def json_or_null(value: Column) -> Column:
    """JSON text of a struct or array; NULL for a missing or empty one."""
    text = F.to_json(value)
    return F.when(~text.isin("{}", "[]"), text)


def sum_amounts(entries: Column, money_field: str) -> Column:
    """Total of a money field over a list; 0.00 for a missing or empty list."""
    zero = F.lit(0).cast("decimal(18,2)")
    total = F.aggregate(
        F.coalesce(entries, F.array()),
        zero,
        lambda acc, entry: (acc + amount_or_zero(entry[money_field])).cast("decimal(18,2)"),
    )
    return total


def _rows(docs: DataFrame, entries: Column, *carried: Column) -> DataFrame:
    """One row per list entry as ``e`` with its 1-based position ``n``; a document's ``place``, if any, is that of its first entry."""
    first = F.col("place") if "place" in docs.columns else F.lit(1)
    return docs.select(*carried, first.alias("first"), F.posexplode(entries).alias("pos", "e")).withColumn("n", F.col("pos") + F.col("first"))


def _stamped(df: DataFrame, table: str, run_ts: RunTime, *columns: Column | str) -> DataFrame:
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")
    return align(df.select(*columns, stamp.alias("extracted_at")), table)


def _of_order(docs: DataFrame, entries: Column) -> DataFrame:
    return _rows(docs, entries, F.col("id").alias("order_id"))


# --- orders and their children ------------------------------------------------------
def flatten_orders(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        docs,
        "stg_orders",
        run_ts,
        "id",
        "name",
        "email",
        *[
            parse_utc(F.col(field)).alias(name)
            for field, name in (
                ("createdAt", "created_at"),
                ("processedAt", "processed_at"),
                ("updatedAt", "updated_at"),
                ("cancelledAt", "cancelled_at"),
                ("closedAt", "closed_at"),
            )
        ],
        F.col("cancelReason").alias("cancel_reason"),
        F.col("currencyCode").alias("currency_code"),
        *[
            amount(F.col(field)).alias(name)
            for field, name in (
                ("subtotalPriceSet", "subtotal_price"),
                ("totalDiscountsSet", "total_discounts"),
                ("totalTaxSet", "total_tax"),
                ("totalShippingPriceSet", "total_shipping"),
                ("totalPriceSet", "total_price"),
                ("totalRefundedSet", "total_refunded"),
            )
        ],
        F.col("displayFinancialStatus").alias("financial_status"),
        F.col("displayFulfillmentStatus").alias("fulfillment_status"),
        F.col("customer.id").alias("customer_id"),
        json_or_null(F.col("shippingAddress")).alias("shipping_address_json"),
        json_or_null(F.col("billingAddress")).alias("billing_address_json"),
        join_array(F.col("tags")).alias("tags"),
        "note",
        F.col("sourceName").alias("source_name"),
    )


def flatten_line_items(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        _of_order(docs, nodes(F.col("lineItems"))),
        "stg_order_line_items",
        run_ts,
        F.col("e.id").alias("id"),
        "order_id",
        F.col("e.variant.id").alias("variant_id"),
        F.col("e.variant.product.id").alias("product_id"),
        F.col("e.title").alias("title"),
        F.col("e.variantTitle").alias("variant_title"),
        F.col("e.sku").alias("sku"),
        F.col("e.quantity").alias("quantity"),
        F.col("e.currentQuantity").alias("current_quantity"),
        F.col("e.unfulfilledQuantity").alias("unfulfilled_quantity"),
        amount(F.col("e.originalUnitPriceSet")).alias("unit_price"),
        amount(F.col("e.originalTotalSet")).alias("total_price"),
        amount(F.col("e.totalDiscountSet")).alias("total_discount"),
        amount(F.col("e.discountedTotalSet")).alias("discounted_total"),
        F.col("e.isGiftCard").alias("is_gift_card"),
        F.col("e.taxable").alias("taxable"),
        F.col("e.requiresShipping").alias("requires_shipping"),
        F.col("e.fulfillableQuantity").alias("fulfillable_quantity"),
    )


def flatten_transactions(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        _of_order(docs, F.col("transactions")),
        "stg_order_transactions",
        run_ts,
        F.col("e.id").alias("id"),
        "order_id",
        F.col("e.kind").alias("kind"),
        F.col("e.status").alias("status"),
        F.col("e.gateway").alias("gateway"),
        amount(F.col("e.amountSet")).alias("amount"),
        F.col("e.amountSet.shopMoney.currencyCode").alias("currency_code"),
        parse_utc(F.col("e.createdAt")).alias("created_at"),
        parse_utc(F.col("e.processedAt")).alias("processed_at"),
        F.col("e.errorCode").alias("error_code"),
    )


def flatten_tax_lines(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        _of_order(docs, F.col("taxLines")),
        "stg_order_tax_lines",
        run_ts,
        "order_id",
        F.col("n").alias("line_number"),
        F.col("e.title").alias("title"),
        F.col("e.rate").alias("rate"),
        amount(F.col("e.priceSet")).alias("price"),
    )


def flatten_discount_applications(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    """The value is money or a percentage; the side that does not apply stays NULL."""
    return _stamped(
        _of_order(docs, nodes(F.col("discountApplications"))),
        "stg_order_discount_applications",
        run_ts,
        "order_id",
        F.col("n").alias("line_number"),
        F.col("e.__typename").alias("discount_type"),
        F.col("e.code").alias("code"),
        F.col("e.title").alias("title"),
        F.col("e.description").alias("description"),
        F.col("e.value.__typename").alias("value_type"),
        F.col("e.value.amount").try_cast("decimal(18,2)").alias("value_amount"),
        F.col("e.value.percentage").alias("value_percentage"),
        F.col("e.targetType").alias("target_type"),
        F.col("e.allocationMethod").alias("allocation_method"),
    )


def flatten_shipping_lines(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        _of_order(docs, nodes(F.col("shippingLines"))),
        "stg_order_shipping_lines",
        run_ts,
        F.col("e.id").alias("id"),
        "order_id",
        F.col("e.title").alias("title"),
        F.col("e.code").alias("code"),
        F.col("e.source").alias("source"),
        amount(F.col("e.originalPriceSet")).alias("original_price"),
        amount(F.col("e.discountedPriceSet")).alias("discounted_price"),
        F.col("e.carrierIdentifier").alias("carrier_identifier"),
    )


def flatten_fulfillments(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    """Only the first tracking entry is kept."""
    tracking = F.try_element_at(F.col("e.trackingInfo"), F.lit(1))
    return _stamped(
        _of_order(docs, F.col("fulfillments")),
        "stg_fulfillments",
        run_ts,
        F.col("e.id").alias("id"),
        "order_id",
        F.col("e.status").alias("status"),
        parse_utc(F.col("e.createdAt")).alias("created_at"),
        parse_utc(F.col("e.updatedAt")).alias("updated_at"),
        tracking["number"].alias("tracking_number"),
        tracking["company"].alias("tracking_company"),
        tracking["url"].alias("tracking_url"),
        F.col("e.location.id").alias("location_id"),
        F.col("e.service.serviceName").alias("service"),
        F.col("e.displayStatus").alias("shipment_status"),
        F.col("e.totalQuantity").alias("total_quantity"),
    )


def _inner(docs: DataFrame, outer: str, connection: str, parent_id: str) -> DataFrame:
    """Entries of a connection inside each element of a list."""
    parents = docs.select(F.explode(outer).alias("p"))
    return _rows(parents, nodes(F.col("p")[connection]), F.col("p.id").alias(parent_id))


def flatten_fulfillment_line_items(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        _inner(docs, "fulfillments", "fulfillmentLineItems", "fulfillment_id"),
        "stg_fulfillment_line_items",
        run_ts,
        "fulfillment_id",
        F.col("e.lineItem.id").alias("line_item_id"),
        F.col("e.quantity").alias("quantity"),
        amount(F.col("e.originalTotalSet")).alias("original_total"),
        amount(F.col("e.discountedTotalSet")).alias("discounted_total"),
    )


def flatten_refunds(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        _of_order(docs, F.col("refunds")),
        "stg_refunds",
        run_ts,
        F.col("e.id").alias("id"),
        "order_id",
        parse_utc(F.col("e.createdAt")).alias("created_at"),
        F.col("e.note").alias("note"),
        amount(F.col("e.totalRefundedSet")).alias("total_refunded"),
    )


def flatten_refund_line_items(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        _inner(docs, "refunds", "refundLineItems", "refund_id"),
        "stg_refund_line_items",
        run_ts,
        "refund_id",
        F.col("e.lineItem.id").alias("line_item_id"),
        F.col("e.quantity").alias("quantity"),
        F.col("e.restockType").alias("restock_type"),
        F.col("e.location.id").alias("location_id"),
        amount(F.col("e.subtotalSet")).alias("subtotal_amount"),
        amount(F.col("e.totalTaxSet")).alias("total_tax_amount"),
    )


# --- other entities -----------------------------------------------------------------
def flatten_customers(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        docs,
        "stg_customers",
        run_ts,
        "id",
        F.col("defaultEmailAddress.emailAddress").alias("email"),
        F.col("defaultPhoneNumber.phoneNumber").alias("phone"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        F.col("defaultEmailAddress.marketingState").alias("email_marketing_state"),
        F.col("defaultPhoneNumber.marketingState").alias("sms_marketing_state"),
        parse_utc(F.col("createdAt")).alias("created_at"),
        parse_utc(F.col("updatedAt")).alias("updated_at"),
        F.col("numberOfOrders").try_cast("int").alias("number_of_orders"),
        F.col("amountSpent.amount").try_cast("decimal(18,2)").alias("amount_spent"),
        json_or_null(F.col("defaultAddress")).alias("default_address_json"),
        join_array(F.col("tags")).alias("tags"),
        "note",
        F.col("taxExempt").alias("tax_exempt"),
    )


def flatten_products(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        docs,
        "stg_products",
        run_ts,
        "id",
        "title",
        "handle",
        "description",
        F.col("productType").alias("product_type"),
        "vendor",
        "status",
        parse_utc(F.col("createdAt")).alias("created_at"),
        parse_utc(F.col("updatedAt")).alias("updated_at"),
        parse_utc(F.col("publishedAt")).alias("published_at"),
        join_array(F.col("tags")).alias("tags"),
    )


def option(options: Column, position: int) -> Column:
    """Value of the option at a 1-based position, NULL when there are fewer."""
    return F.try_element_at(options, F.lit(position))["value"]


def flatten_variants(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        docs,
        "stg_product_variants",
        run_ts,
        "id",
        F.col("product.id").alias("product_id"),
        "title",
        "sku",
        "barcode",
        F.col("price").try_cast("decimal(18,2)").alias("price"),
        F.col("compareAtPrice").try_cast("decimal(18,2)").alias("compare_at_price"),
        F.col("inventoryItem.unitCost.amount").try_cast("decimal(18,2)").alias("cost"),
        "taxable",
        F.col("inventoryItem.requiresShipping").alias("requires_shipping"),
        F.col("inventoryItem.measurement.weight.value").alias("weight"),
        F.col("inventoryItem.measurement.weight.unit").alias("weight_unit"),
        *[option(F.col("selectedOptions"), i).alias(f"option{i}") for i in (1, 2, 3)],
        F.col("inventoryItem.id").alias("inventory_item_id"),
        parse_utc(F.col("createdAt")).alias("created_at"),
        parse_utc(F.col("updatedAt")).alias("updated_at"),
    )


def flatten_locations(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    return _stamped(
        docs,
        "stg_locations",
        run_ts,
        "id",
        "name",
        "address.address1",
        "address.address2",
        "address.city",
        "address.province",
        F.col("address.provinceCode").alias("province_code"),
        "address.country",
        F.col("address.countryCode").alias("country_code"),
        "address.zip",
        "address.phone",
        F.col("isActive").alias("is_active"),
        F.col("fulfillsOnlineOrders").alias("fulfills_online_orders"),
    )


def flatten_inventory_levels(docs: DataFrame, run_ts: RunTime, snapshot_date: date | Column) -> DataFrame:
    """The name/quantity list becomes one column per kept state."""
    day = snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date)
    levels = _rows(docs.withColumn("day", day), nodes(F.col("inventoryLevels")), F.col("id"), F.col("day"))
    quantities = F.coalesce(F.col("e.quantities"), F.array())

    def state(name: str) -> Column:  # the last entry wins when a name repeats
        return F.try_element_at(F.filter(quantities, lambda q: q["name"] == name), F.lit(-1))["quantity"]

    return _stamped(
        levels,
        "stg_inventory_levels",
        run_ts,
        F.col("id").alias("inventory_item_id"),
        F.col("e.location.id").alias("location_id"),
        *[state(name).alias(name) for name in QUANTITY_NAMES],
        parse_utc(F.col("e.updatedAt")).alias("updated_at"),
        F.col("day").alias("snapshot_date"),
    )


def flatten_abandoned_checkouts(docs: DataFrame, run_ts: RunTime) -> DataFrame:
    lines = nodes(F.col("lineItems"))
    return _stamped(
        docs,
        "stg_abandoned_checkouts",
        run_ts,
        "id",
        parse_utc(F.col("createdAt")).alias("created_at"),
        parse_utc(F.col("updatedAt")).alias("updated_at"),
        parse_utc(F.col("completedAt")).alias("completed_at"),
        F.col("customer.id").alias("customer_id"),
        amount(F.col("subtotalPriceSet")).alias("subtotal_price"),
        amount(F.col("totalTaxSet")).alias("total_tax"),
        amount(F.col("totalPriceSet")).alias("total_price"),
        F.col("totalPriceSet.shopMoney.currencyCode").alias("currency_code"),
        F.col("abandonedCheckoutUrl").alias("abandoned_checkout_url"),
        F.size(lines).alias("line_items_count"),
        json_or_null(lines).alias("line_items_json"),
        json_or_null(F.col("shippingAddress")).alias("shipping_address_json"),
    )


# --- truncation report ----------------------------------------------------------------
def oversized(docs: DataFrame, connection: str, limit: int) -> DataFrame:
    """Documents whose inner list is longer than the source's page or was cut by it.

    Nothing is cut here; the count tells how many parents the source may have cut.
    """
    cut = F.col(f"{connection}.pageInfo.hasNextPage")
    return docs.filter((F.size(F.col(f"{connection}.edges")) > limit) | cut).agg(
        F.count(F.lit(1)).alias("oversized_parents")
    )


def cap_list(docs: DataFrame, connection: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """Documents with the first ``limit`` entries of an inner list, and documents that hold the entries beyond."""
    edges = F.col(f"{connection}.edges")
    part = lambda rows, first, count: rows.withColumn(connection, F.col(connection).withField("edges", F.slice(edges, first, count)))
    return part(docs, 1, limit), part(docs.filter(F.size(edges) > limit), limit + 1, F.size(edges))


ORDER_FLATTENERS: dict[str, Callable[[DataFrame, RunTime], DataFrame]] = {
    "stg_orders": flatten_orders,
    "stg_order_line_items": flatten_line_items,
    "stg_order_transactions": flatten_transactions,
    "stg_order_tax_lines": flatten_tax_lines,
    "stg_order_discount_applications": flatten_discount_applications,
    "stg_order_shipping_lines": flatten_shipping_lines,
    "stg_fulfillments": flatten_fulfillments,
    "stg_fulfillment_line_items": flatten_fulfillment_line_items,
    "stg_refunds": flatten_refunds,
    "stg_refund_line_items": flatten_refund_line_items,
}
