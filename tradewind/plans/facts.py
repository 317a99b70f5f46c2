"""Fact builds.

Pattern: orders and their children are stored in buckets of the order number (``ORDER_NUMBER``), and
the wide staging row stays there. Lookups and child aggregates run on narrow frames, carry only the
order number, the row's own key and the looked-up columns, and move to the wide row. Without buckets
the wide row is shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import (
    date_key,
    days_between,
    first_match,
    flag,
    id_digits,
    micros_between,
    one_of,
    percent_of,
    zero,
)
from tradewind.operators.addresses import NO_ADDRESS, address_key, parse_addresses
from tradewind.operators.relational import align, first_rows, join_packed, ordinal_pivot, spread_nulls
from tradewind.operators.row_index import Numbering, row_index
from tradewind.sources import schemas

Tables = Mapping[str, DataFrame]

# --- fixed values -------------------------------------------------------------
PAID_STATES = ("PAID", "PARTIALLY_REFUNDED")
RESTOCKED = ("RETURN", "CANCEL")
NOT_RESTOCKED = "NO_RESTOCK"
APPLIED_VALUE_TYPES = {"Percentage": "percentage", "Money": "fixed"}
FULL_REFUND_PERCENT = 99
LOW_STOCK, OVERSTOCK = 10, 500
HEADER = (
    "name email checkout_id source_name landing_site referring_site created_at processed_at cancelled_at closed_at "
    "subtotal_price total_shipping total_tax total_discounts total_price total_refunded currency_code financial_status "
    "fulfillment_status cancel_reason tags note"
).split()
_HOUR, _DAY = 3_600_000_000, 86_400_000_000


#: The order number of a child of orders; stored beside the declared columns where the table is kept in buckets of it.
ORDER_NUMBER = ("order_num", lambda: id_digits(F.col("order_id")))


def with_order_number(children: DataFrame) -> DataFrame:
    """Children with their order number, the stored one if there is one: computed anew it would not fit the buckets."""
    return children if ORDER_NUMBER[0] in children.columns else children.withColumn(ORDER_NUMBER[0], ORDER_NUMBER[1]())


def in_place(stg: Tables, table: str) -> DataFrame:
    """Staged orders or children of theirs with their order number, in its buckets where the store keeps them so."""
    if hasattr(stg, "co_located"):
        return stg.co_located(table)
    return stg[table].withColumn(ORDER_NUMBER[0], id_digits(F.col("id"))) if table == "stg_orders" else with_order_number(stg[table])


def with_headers(wide: DataFrame, own: str, headers: DataFrame, *found: DataFrame) -> DataFrame:
    """Children of orders with what narrow frames ``found`` for them, by order number and ``own`` key, and with their orders' columns.

    Where a join on both keys stays in the buckets of the order number, headers come last and need no order of their own: the wide row
    is sorted once. Elsewhere such a join moves the wide row, so it meets its headers in the buckets first and is moved once, by its own key.
    """
    stays = wide.sparkSession.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"
    out = wide if stays else wide.join(headers, ORDER_NUMBER[0])
    for part in found:
        out = out.join(part, [ORDER_NUMBER[0], own] if stays else [own, ORDER_NUMBER[0]])
    return out.join(headers, ORDER_NUMBER[0]) if stays else out


# --- order header ---------------------------------------------------------------
def order_payments(transactions: DataFrame, width: int) -> DataFrame:
    """Successful sales of an order: the first ``width`` as columns, and how many there were."""
    sales = transactions.filter((F.col("kind") == "SALE") & (F.col("status") == "SUCCESS")).select(
        id_digits(F.col("order_id")).alias("oid"), "created_at", "id", "gateway", "amount"
    )
    firsts = ordinal_pivot(
        sales,
        "oid",
        [F.col("created_at"), F.col("id")],
        width,
        {"gateway": "payment_{}_gateway", "amount": "payment_{}_amount"},
    )
    totals = sales.groupBy("oid").agg(F.count(F.lit(1)).alias("total_payment_count"))
    return totals.join(firsts, "oid", "left")


def order_taxes(tax_lines: DataFrame, width: int) -> DataFrame:
    return ordinal_pivot(
        tax_lines.withColumn("oid", id_digits(F.col("order_id"))),
        "oid",
        [F.col("line_number")],
        width,
        {"title": "tax_{}_name", "rate": "tax_{}_rate", "price": "tax_{}_amount"},
    )


def order_discounts(applications: DataFrame, width: int) -> DataFrame:
    return ordinal_pivot(
        applications.select(
            id_digits(F.col("order_id")).alias("oid"),
            "line_number",
            "code",
            first_match(F.col("value_type"), APPLIED_VALUE_TYPES, default=F.col("value_type")).alias("kind"),
            F.coalesce("value_amount", "value_percentage").alias("value"),
        ),
        "oid",
        [F.col("line_number")],
        width,
        {"code": "discount_{}_code", "kind": "discount_{}_type", "value": "discount_{}_amount"},
    )


def order_shipping(shipping_lines: DataFrame) -> DataFrame:
    first = first_rows(
        shipping_lines.withColumn("oid", id_digits(F.col("order_id"))), ["oid"], [F.col("id")], 1
    )
    return first.select(
        "oid", F.col("title").alias("shipping_method"), F.col("carrier_identifier").alias("shipping_carrier")
    )


def order_lines(lines: DataFrame) -> DataFrame:
    return with_order_number(lines).groupBy(F.col(ORDER_NUMBER[0]).alias("oid")).agg(
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.countDistinct("product_id").alias("unique_product_count"),
    )


def order_customers(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customer attributes per order. Guests keep a row and match nothing."""
    cust = id_digits(F.col("customer_id"))
    slim = orders.select(
        F.col("o_num").alias("oid"),
        F.col("created_at"),
        F.col("customer_id").isNotNull().alias("has_customer"),
        spread_nulls(cust, F.col("o_num")).alias("cust_num"),
    )
    first_seen = slim.filter("has_customer").groupBy("cust_num").agg(F.min("created_at").alias("first_created"))
    people = dim_customer.filter("customer_id is not null").select(
        F.col("customer_id").alias("cust_num"),
        "customer_key",
        F.col("email").alias("known_email"),
        F.col("full_name").alias("customer_name"),
        "customer_segment",
        (F.col("lifetime_order_count") > 1).alias("repeats"),
    )
    # Both lookups hold one row per customer and meet first, so the orders take part in a
    # single join that can be split where one customer holds a large share of them.
    lookup = first_seen.join(people, "cust_num", "full")
    return slim.join(lookup, "cust_num", "left").select(
        "oid",
        "customer_key",
        "known_email",
        "customer_name",
        "customer_segment",
        "repeats",
        flag(F.col("has_customer") & (F.col("created_at") == F.col("first_created"))).alias("is_first_order"),
    )


def order_geographies(orders: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Both address roles looked up in one join, then laid side by side per order."""
    roles = orders.select(
        F.col("o_num").alias("oid"),
        F.explode(
            F.create_map(F.lit("ship"), F.col("shipping_address_json"), F.lit("bill"), F.col("billing_address_json"))
        ).alias("role", "text"),
    )
    parts = parse_addresses(roles, "text", fields=("city", "province", "country", "postal_code"))
    keyed = parts.select("oid", "role", address_key().alias("address_hash"))
    found = keyed.filter(F.col("address_hash") != NO_ADDRESS).join(
        dim_geography.select("address_hash", "geography_key", "city", "province", "country", "country_code"),
        "address_hash",
    )
    shipping = F.col("role") == "ship"
    return found.groupBy("oid").agg(
        F.max(F.when(shipping, F.col("geography_key"))).alias("ship_key"),
        F.max(F.when(~shipping, F.col("geography_key"))).alias("bill_key"),
        *[
            F.max(F.when(shipping, F.col(c))).alias(f"shipping_{c}")
            for c in ("city", "province", "country", "country_code")
        ],
    )


def one_row_per_code(dim_discount: DataFrame) -> DataFrame:
    """A code that the shop holds twice stands for its first row, so that it cannot multiply orders."""
    coded = dim_discount.filter("discount_code is not null")
    return coded.groupBy("discount_code").agg(
        *[F.min_by(c, "discount_key").alias(c) for c in coded.columns if c not in ("discount_code", "discount_key")],
        F.min("discount_key").alias("discount_key"),
    )


def fact_order(stg: Tables, dims: Tables, loaded_at: Column, number: Numbering = row_index) -> DataFrame:
    orders = in_place(stg, "stg_orders").withColumnRenamed(ORDER_NUMBER[0], "o_num")
    keyed = number(
        orders.select("created_at", "id", "o_num"), ["created_at", "id"], "order_key"
    ).select(F.col("o_num").alias("oid"), "order_key")
    codes = one_row_per_code(dims["dim_discount"]).select("discount_code", "discount_key")
    discounts = order_discounts(stg["stg_order_discount_applications"], schemas.PIVOT_WIDTHS["discounts"]).withColumn(
        "lookup_code", spread_nulls(F.col("discount_1_code"), F.col("oid"))
    )
    discounts = discounts.join(codes, F.col("lookup_code") == F.col("discount_code"), "left").drop(
        "lookup_code", "discount_code"
    )
    # Every part joins on the order number, so the wide header stays in its buckets.
    full = join_packed(
        orders.select(F.col("o_num").alias("oid"), *HEADER),
        "oid",
        {
            "k": keyed,
            "c": order_customers(orders, dims["dim_customer"]),
            "g": order_geographies(orders, dims["dim_geography"]),
            "p": order_payments(stg["stg_order_transactions"], schemas.PIVOT_WIDTHS["payments"]),
            "t": order_taxes(stg["stg_order_tax_lines"], schemas.PIVOT_WIDTHS["taxes"]),
            "d": discounts,
            "s": order_shipping(stg["stg_order_shipping_lines"]),
            "l": order_lines(in_place(stg, "stg_order_line_items")),
        },
    )

    created = F.col("created_at")
    built = full.select(
        "order_key",
        date_key(created).alias("order_date_key"),
        F.hour(created).alias("order_time_key"),
        F.coalesce("customer_key", F.lit(-1)).alias("customer_key"),
        F.coalesce("ship_key", F.lit(-1)).alias("shipping_geography_key"),
        F.coalesce("bill_key", F.lit(-1)).alias("billing_geography_key"),
        F.col("oid").alias("order_id"),
        F.col("name").alias("order_number"),
        F.col("email").alias("order_email"),
        "checkout_id",
        "source_name",
        "landing_site",
        "referring_site",
        created.alias("order_created_at"),
        F.col("processed_at").alias("order_processed_at"),
        F.col("cancelled_at").alias("order_cancelled_at"),
        F.col("closed_at").alias("order_closed_at"),
        F.col("subtotal_price").alias("subtotal_amount"),
        F.col("total_shipping").alias("shipping_amount"),
        F.col("total_tax").alias("tax_amount"),
        F.col("total_discounts").alias("discount_amount"),
        F.col("total_price").alias("total_amount"),
        F.col("total_refunded").alias("refund_amount"),
        (F.col("total_price") - zero(F.col("total_refunded"))).alias("net_amount"),
        "currency_code",
        *[f"payment_{i + 1}_{part}" for i in range(schemas.PIVOT_WIDTHS["payments"]) for part in ("gateway", "amount")],
        zero(F.col("total_payment_count")).alias("total_payment_count"),
        *[f"tax_{i + 1}_{part}" for i in range(schemas.PIVOT_WIDTHS["taxes"]) for part in ("name", "rate", "amount")],
        *[f"discount_{i + 1}_{part}" for i in range(schemas.PIVOT_WIDTHS["discounts"]) for part in ("code", "type", "amount")],
        zero(F.col("discount_key")).alias("primary_discount_key"),
        "shipping_method",
        "shipping_carrier",
        "financial_status",
        "fulfillment_status",
        "cancel_reason",
        one_of(F.col("financial_status"), PAID_STATES).alias("is_paid"),
        flag(F.col("financial_status") == "REFUNDED").alias("is_fully_refunded"),
        F.col("cancelled_at").isNotNull().alias("is_cancelled"),
        flag(F.col("fulfillment_status") == "FULFILLED").alias("is_fulfilled"),
        flag(F.col("total_discounts") > 0).alias("has_discount"),
        flag(F.col("total_payment_count") > 1).alias("has_multiple_payments"),
        zero(F.col("line_item_count")).alias("line_item_count"),
        zero(F.col("total_quantity")).alias("total_quantity"),
        zero(F.col("unique_product_count")).alias("unique_product_count"),
        F.coalesce("known_email", "email").alias("customer_email"),
        "customer_name",
        "customer_segment",
        "is_first_order",
        flag(F.col("repeats")).alias("is_repeat_customer"),
        "shipping_city",
        "shipping_province",
        "shipping_country",
        "shipping_country_code",
        "tags",
        F.col("note").alias("notes"),
        loaded_at.alias("loaded_at"),
    )
    return align(built, "fact_order")


# --- order lines ----------------------------------------------------------------
def fact_order_line_item(lines: DataFrame, fact_order: DataFrame, dim_product: DataFrame, loaded_at: Column, number: Numbering = row_index) -> DataFrame:
    """One row per line of a known order; a variant that is gone becomes the Unknown product.

    Lines meet their orders in place. Keys and products are found on narrow frames, which carry the order number to the wide line.
    """
    numbered = with_order_number(lines)
    headers = fact_order.select(
        F.col("order_id").alias("order_num"),
        "order_key",
        "order_date_key",
        "order_time_key",
        "customer_key",
        "order_number",
        "order_created_at",
        "financial_status",
        "fulfillment_status",
        "customer_email",
        "customer_name",
        "shipping_country",
        "shipping_country_code",
    )
    catalogue = dim_product.filter("variant_id is not null").select(
        F.col("variant_id").alias("variant_num"), "product_key", "product_type", "vendor", "unit_cost"
    )
    keyed = number(
        numbered.select("id", "order_num").join(headers.select("order_num"), "order_num", "left_semi"),
        ["id"],
        "line_item_key",
    )
    variants = numbered.select("id", "order_num", spread_nulls(id_digits(F.col("variant_id")), F.col("id")).alias("variant_num"))
    sold = variants.join(catalogue, "variant_num", "left").drop("variant_num")
    full = with_headers(numbered, "id", headers, sold, keyed)
    ordered, open_units = zero(F.col("quantity")), zero(F.col("unfulfilled_quantity"))
    returned = ordered - F.coalesce("current_quantity", "quantity")
    net = F.col("discounted_total")
    margin = net - zero(F.col("unit_cost")) * ordered
    built = full.select(
        "line_item_key",
        "order_key",
        "order_date_key",
        "order_time_key",
        F.coalesce("product_key", F.lit(-1)).alias("product_key"),
        "customer_key",
        id_digits(F.col("id")).alias("line_item_id"),
        F.col("order_num").alias("order_id"),
        "order_number",
        "sku",
        F.col("title").alias("product_title"),
        "variant_title",
        "product_type",
        "vendor",
        F.col("quantity").alias("quantity_ordered"),
        (ordered - open_units).alias("quantity_fulfilled"),
        returned.alias("quantity_refunded"),
        F.col("current_quantity").alias("quantity_current"),
        "unit_price",
        "unit_cost",
        F.col("total_price").alias("gross_amount"),
        F.col("total_discount").alias("discount_amount"),
        net.alias("net_amount"),
        margin.alias("gross_margin"),
        percent_of(margin, net).alias("gross_margin_percent"),
        "is_gift_card",
        F.col("taxable").alias("is_taxable"),
        (open_units == 0).alias("is_fulfilled"),
        flag((open_units > 0) & (open_units < F.col("quantity"))).alias("is_partially_fulfilled"),
        flag(returned > 0).alias("is_refunded"),
        flag(F.col("current_quantity") == 0).alias("is_fully_refunded"),
        F.col("order_created_at").cast("date").alias("order_created_date"),
        F.col("financial_status").alias("order_financial_status"),
        F.col("fulfillment_status").alias("order_fulfillment_status"),
        "customer_email",
        "customer_name",
        "shipping_country",
        "shipping_country_code",
        loaded_at.alias("loaded_at"),
    )
    return align(built, "fact_order_line_item")


# --- fulfilments ----------------------------------------------------------------
def fact_fulfillment(
    fulfillments: DataFrame, fulfillment_lines: DataFrame, fact_order: DataFrame, dim_location: DataFrame, loaded_at: Column, number: Numbering = row_index
) -> DataFrame:
    line_counts = fulfillment_lines.groupBy(id_digits(F.col("fulfillment_id")).alias("fid")).agg(
        F.count(F.lit(1)).alias("line_item_count")
    )
    headers = fact_order.select(
        F.col("order_id").alias("order_num"),
        "order_key",
        "order_date_key",
        "customer_key",
        "order_number",
        "order_created_at",
        "shipping_country",
        "customer_email",
        "customer_name",
    )
    places = dim_location.filter("location_id is not null").select(
        F.col("location_id").alias("loc_num"), "location_key", "location_name"
    )
    shipped = with_order_number(fulfillments).withColumn("fid", id_digits(F.col("id")))
    keyed = number(
        shipped.select("id", "created_at", "fid", "order_num").join(
            headers.select("order_num"), "order_num", "left_semi"
        ),
        ["created_at", "id"],
        "fulfillment_key",
    ).select("fid", "order_num", "fulfillment_key")
    origins = shipped.select("fid", "order_num", spread_nulls(id_digits(F.col("location_id")), F.col("fid")).alias("loc_num"))
    sent = origins.join(places, "loc_num", "left").drop("loc_num").join(line_counts, "fid", "left")
    full = with_headers(shipped, "fid", headers, sent, keyed)
    elapsed = micros_between(F.col("created_at"), F.col("order_created_at"))
    exact = elapsed.cast("decimal(20,0)")
    built = full.select(
        "fulfillment_key",
        "order_key",
        "order_date_key",
        date_key(F.col("created_at")).alias("fulfillment_date_key"),
        F.hour("created_at").alias("fulfillment_time_key"),
        F.coalesce("location_key", F.lit(-1)).alias("location_key"),
        "customer_key",
        F.col("fid").alias("fulfillment_id"),
        F.col("order_num").alias("order_id"),
        "order_number",
        "order_created_at",
        F.col("created_at").alias("fulfillment_created_at"),
        F.col("updated_at").alias("fulfillment_updated_at"),
        (exact / F.lit(_HOUR).cast("decimal(10,0)")).alias("fulfillment_time_hours"),
        (exact / F.lit(_DAY).cast("decimal(11,0)")).alias("fulfillment_time_days"),
        "tracking_number",
        "tracking_company",
        "tracking_url",
        F.col("service").alias("shipping_service"),
        F.col("status").alias("fulfillment_status"),
        "shipment_status",
        flag(F.col("status") == "SUCCESS").alias("is_successful"),
        flag(F.col("status") == "PENDING").alias("is_pending"),
        "total_quantity",
        zero(F.col("line_item_count")).alias("line_item_count"),
        "location_name",
        "customer_email",
        "customer_name",
        "shipping_country",
        flag(elapsed < 24 * _HOUR).alias("is_same_day"),
        flag(elapsed <= 48 * _HOUR).alias("is_within_48h"),
        flag(elapsed > 72 * _HOUR).alias("is_late"),
        loaded_at.alias("loaded_at"),
    )
    return align(built, "fact_fulfillment")


# --- refunds --------------------------------------------------------------------
def refund_line_totals(refund_lines: DataFrame) -> DataFrame:
    units, how = F.col("quantity"), F.col("restock_type")
    return refund_lines.groupBy(id_digits(F.col("refund_id")).alias("rid")).agg(
        F.sum(units).alias("total_items_refunded"),
        F.sum("subtotal_amount").alias("refund_subtotal"),
        F.sum("total_tax_amount").alias("refund_tax"),
        F.countDistinct("line_item_id").alias("line_item_count"),
        F.sum(F.when(how.isin(*RESTOCKED), units).otherwise(0)).alias("items_restocked"),
        F.sum(F.when(how == NOT_RESTOCKED, units).otherwise(0)).alias("items_not_restocked"),
    )


def fact_refund(refunds: DataFrame, refund_lines: DataFrame, fact_order: DataFrame, loaded_at: Column, number: Numbering = row_index) -> DataFrame:
    headers = fact_order.select(
        F.col("order_id").alias("order_num"),
        "order_key",
        "order_date_key",
        "customer_key",
        "order_number",
        "order_created_at",
        "total_amount",
        "customer_email",
        "customer_name",
    )
    given = with_order_number(refunds).withColumn("rid", id_digits(F.col("id")))
    keyed = number(
        given.select("id", "created_at", "rid", "order_num").join(
            headers.select("order_num"), "order_num", "left_semi"
        ),
        ["created_at", "id"],
        "refund_key",
    ).select("rid", "order_num", "refund_key")
    counted = keyed.join(refund_line_totals(refund_lines), "rid", "left")
    full = with_headers(given, "rid", headers, counted)
    share = percent_of(F.col("total_refunded"), F.col("total_amount"))
    built = full.select(
        "refund_key",
        "order_key",
        "order_date_key",
        date_key(F.col("created_at")).alias("refund_date_key"),
        "customer_key",
        F.col("rid").alias("refund_id"),
        F.col("order_num").alias("order_id"),
        "order_number",
        "order_created_at",
        F.col("created_at").alias("refund_created_at"),
        days_between(F.col("created_at"), F.col("order_created_at")).alias("days_to_refund"),
        F.col("total_refunded").alias("refund_amount"),
        zero(F.col("refund_subtotal")).alias("refund_subtotal"),
        zero(F.col("refund_tax")).alias("refund_tax"),
        F.col("total_amount").alias("original_order_total"),
        share.alias("refund_percentage"),
        zero(F.col("total_items_refunded")).alias("total_items_refunded"),
        zero(F.col("line_item_count")).alias("line_item_count"),
        zero(F.col("items_restocked")).alias("items_restocked"),
        zero(F.col("items_not_restocked")).alias("items_not_restocked"),
        F.col("note").alias("refund_note"),
        flag(share >= FULL_REFUND_PERCENT).alias("is_full_refund"),
        flag((share > 0) & (share < FULL_REFUND_PERCENT)).alias("is_partial_refund"),
        flag(F.col("items_restocked") > 0).alias("has_restock"),
        "customer_email",
        "customer_name",
        loaded_at.alias("loaded_at"),
    )
    return align(built, "fact_refund")


# --- inventory ------------------------------------------------------------------
def fact_inventory_snapshot(
    levels: DataFrame, variants: DataFrame, dim_product: DataFrame, dim_location: DataFrame, loaded_at: Column
) -> DataFrame:
    items = variants.select(
        id_digits(F.col("inventory_item_id")).alias("item_num"), id_digits(F.col("id")).alias("variant_num")
    ).filter("item_num is not null")
    catalogue = dim_product.filter("variant_id is not null").select(
        F.col("variant_id").alias("variant_num"),
        "product_key",
        "unit_cost",
        "current_price",
        "sku",
        "product_title",
        "variant_title",
        "product_type",
        "vendor",
    )
    # Item -> product resolves once per item, not once per snapshot row. Levels, items and products grow with the shop, but packed
    # files show Spark a hundredth of their rows' size: told to merge, it sends none of them through the driver as a broadcast.
    stocked = items.join(catalogue.hint("merge"), "variant_num", "left").drop("variant_num")
    places = dim_location.filter("location_id is not null").select(
        F.col("location_id").alias("loc_num"), "location_key", "location_name", F.col("country").alias("location_country")
    )
    # A level without a location still counts, so the join key may not be NULL.
    levels = levels.withColumn("place", F.coalesce("location_id", F.lit("")))
    keys = ["snapshot_date", "inventory_item_id", "place"]
    keyed = row_index(levels.select(*keys), [F.col(c) for c in keys], "inventory_snapshot_key")
    full = (
        levels.join(keyed.hint("merge"), keys)
        .withColumn("item_num", id_digits(F.col("inventory_item_id")))
        .withColumn("loc_num", id_digits(F.col("location_id")))
        .join(stocked.hint("merge"), "item_num", "left")
        .join(places, "loc_num", "left")
    )
    available, on_hand = F.col("available"), zero(F.col("on_hand"))
    built = full.select(
        "inventory_snapshot_key",
        date_key(F.col("snapshot_date")).alias("snapshot_date_key"),
        F.coalesce("product_key", F.lit(-1)).alias("product_key"),
        F.coalesce("location_key", F.lit(-1)).alias("location_key"),
        F.col("item_num").alias("inventory_item_id"),
        F.col("loc_num").alias("location_id"),
        "snapshot_date",
        available.alias("available_quantity"),
        F.col("on_hand").alias("on_hand_quantity"),
        F.col("committed").alias("committed_quantity"),
        F.col("incoming").alias("incoming_quantity"),
        F.col("reserved").alias("reserved_quantity"),
        (on_hand + zero(F.col("incoming"))).alias("total_inventory"),
        available.alias("sellable_inventory"),
        "unit_cost",
        (on_hand * zero(F.col("unit_cost"))).alias("inventory_cost_value"),
        F.col("current_price").alias("unit_price"),
        (on_hand * zero(F.col("current_price"))).alias("inventory_retail_value"),
        "sku",
        "product_title",
        "variant_title",
        "product_type",
        "vendor",
        "location_name",
        "location_country",
        (zero(available) == 0).alias("is_out_of_stock"),
        flag((available > 0) & (available < LOW_STOCK)).alias("is_low_stock"),
        flag(available > OVERSTOCK).alias("is_overstocked"),
        loaded_at.alias("loaded_at"),
    )
    return align(built, "fact_inventory_snapshot")
