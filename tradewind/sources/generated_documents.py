"""Source documents rebuilt from the generated tables.

Each document comes from one row: an order row carries its own payments, taxes,
discounts and shipping lines, and every line, shipment or refund row becomes a page of
its order with one entry. No group of rows is ever collected into one document.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import id_digits
from tradewind.operators.relational import align
from tradewind.sources import adapter
from tradewind.sources.adapter import Sources
from tradewind.sources.documents import _ADDRESS

Staging = Mapping[str, DataFrame]
Field = Callable[[str], Column]
NUMBER = "order_num"  # the column that staged orders and their children are kept in buckets of


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _bag(value: Column, currency: Column | None = None) -> Column:
    currency = F.lit("ZAR") if currency is None else currency
    return F.when(
        value.isNotNull(),
        F.struct(F.struct(value.cast("string").alias("amount"), currency.alias("currencyCode")).alias("shopMoney")),
    )


def _ref(value: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(value.alias("id")))


def _edges(entries: Column) -> Column:
    return F.struct(
        F.transform(entries, lambda node: F.struct(node.alias("node"))).alias("edges"),
        F.struct(F.lit(False).alias("hasNextPage")).alias("pageInfo"),
    )


def _list(count: Column, entry: Callable[[Column], Column]) -> Column:
    numbers = F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, entry)


def _renamed(fields: Mapping[str, Column], names: Mapping[str, str]) -> list[Column]:
    return [fields[source].alias(target) for source, target in names.items()]


def _transaction(k: Column, i: Column) -> Column:
    f = adapter.transaction_fields(k, i)
    return F.struct(
        *_renamed(f, {"id": "id", "kind": "kind", "status": "status", "gateway": "gateway", "error_code": "errorCode"}),
        _bag(f["amount"], f["currency_code"]).alias("amountSet"),
        _iso(f["created_at"]).alias("createdAt"),
        _iso(f["processed_at"]).alias("processedAt"),
    )


def _tax_line(k: Column, i: Column) -> Column:
    f = adapter.tax_line_fields(k, i)
    return F.struct(f["title"].alias("title"), f["rate"].cast("double").alias("rate"), _bag(f["price"]).alias("priceSet"))


def _discount(k: Column, i: Column) -> Column:
    f = adapter.discount_fields(k, i)
    value = F.struct(
        f["value_type"].alias("__typename"),
        f["value_amount"].cast("string").alias("amount"),
        f["value_percentage"].cast("double").alias("percentage"),
    )
    return F.struct(
        *_renamed(f, {"discount_type": "__typename", "code": "code", "title": "title", "description": "description"}),
        *_renamed(f, {"target_type": "targetType", "allocation_method": "allocationMethod"}),
        value.alias("value"),
    )


def _shipping_line(k: Column, i: Column) -> Column:
    f = adapter.shipping_line_fields(k, i)
    return F.struct(
        *_renamed(f, {"id": "id", "title": "title", "code": "code", "source": "source"}),
        f["carrier_identifier"].alias("carrierIdentifier"),
        _bag(f["original_price"]).alias("originalPriceSet"),
        _bag(f["discounted_price"]).alias("discountedPriceSet"),
    )


def _placed(stg: Staging, table: str) -> DataFrame:
    """Staged orders or children of theirs with their order's number, in its buckets where the store keeps them so."""
    if hasattr(stg, "co_located"):
        return stg.co_located(table)
    return stg[table].withColumn(NUMBER, id_digits(F.col("id" if table == "stg_orders" else "order_id")))


def _made(src: Sources, table: str) -> DataFrame:
    """Rows that one generated row determines, made where they are read: stored and dealt they would only be moved once more."""
    return align(adapter.BUILDERS[table](src), table)


def order_documents(src: Sources, stg: Staging) -> DataFrame:
    """Order headers with the lists that an order row determines."""
    return _numbered_documents(src, stg).drop(NUMBER)


def _numbered_documents(src: Sources, stg: Staging) -> DataFrame:
    """Documents of orders with the order's number. Narrow rows are moved to the staged orders, which stay where they lie."""
    k = F.col("o_orderkey")
    rows = src["orders"].select(k.cast("string").alias(NUMBER), "o_orderkey", "o_orderdate", "o_totalprice")
    return _placed(stg, "stg_orders").join(rows, NUMBER).select(
        NUMBER,
        *_header(),
        _list(adapter.transaction_count(k), lambda i: _transaction(k, i)).alias("transactions"),
        _list(adapter.tax_line_count(k), lambda i: _tax_line(k, i)).alias("taxLines"),
        _edges(_list(adapter.discount_count(k), lambda i: _discount(k, i))).alias("discountApplications"),
        _edges(_list(adapter.shipping_line_count(k), lambda i: _shipping_line(k, i))).alias("shippingLines"),
    )


def _header() -> list[Column | str]:
    """The columns of a staged order as a document's fields."""
    return [
        "id",
        "name",
        "email",
        "note",
        *[
            _iso(F.col(name)).alias(field)
            for name, field in (
                ("created_at", "createdAt"),
                ("processed_at", "processedAt"),
                ("updated_at", "updatedAt"),
                ("cancelled_at", "cancelledAt"),
                ("closed_at", "closedAt"),
            )
        ],
        F.col("cancel_reason").alias("cancelReason"),
        F.col("currency_code").alias("currencyCode"),
        *[
            _bag(F.col(name), F.col("currency_code")).alias(field)
            for name, field in (
                ("subtotal_price", "subtotalPriceSet"),
                ("total_discounts", "totalDiscountsSet"),
                ("total_tax", "totalTaxSet"),
                ("total_shipping", "totalShippingPriceSet"),
                ("total_price", "totalPriceSet"),
                ("total_refunded", "totalRefundedSet"),
            )
        ],
        F.col("financial_status").alias("displayFinancialStatus"),
        F.col("fulfillment_status").alias("displayFulfillmentStatus"),
        _ref(F.col("customer_id")).alias("customer"),
        F.from_json("shipping_address_json", _ADDRESS).alias("shippingAddress"),
        F.from_json("billing_address_json", _ADDRESS).alias("billingAddress"),
        F.split("tags", ",").alias("tags"),
        F.col("source_name").alias("sourceName"),
    ]


def _line(c: Field) -> Column:
    return F.struct(
        c("id").alias("id"),
        c("title").alias("title"),
        c("variant_title").alias("variantTitle"),
        c("sku").alias("sku"),
        c("quantity").alias("quantity"),
        c("current_quantity").alias("currentQuantity"),
        c("unfulfilled_quantity").alias("unfulfilledQuantity"),
        c("fulfillable_quantity").alias("fulfillableQuantity"),
        c("is_gift_card").alias("isGiftCard"),
        c("taxable").alias("taxable"),
        c("requires_shipping").alias("requiresShipping"),
        F.when(
            c("variant_id").isNotNull(), F.struct(c("variant_id").alias("id"), F.struct(c("product_id").alias("id")).alias("product"))
        ).alias("variant"),
        _bag(c("unit_price")).alias("originalUnitPriceSet"),
        _bag(c("total_price")).alias("originalTotalSet"),
        _bag(c("total_discount")).alias("totalDiscountSet"),
        _bag(c("discounted_total")).alias("discountedTotalSet"),
    )


def line_documents(src: Sources, stg: Staging) -> DataFrame:
    return _made(src, "stg_order_line_items").select(F.col("order_id").alias("id"), _edges(F.array(_line(F.col))).alias("lineItems"))


def line_list_documents(src: Sources, stg: Staging) -> DataFrame:
    """All lines of an order in one document, in the order of their ids; the generated orders have seven at most.

    Lines that are kept in buckets of their order number are grouped where they lie.
    """
    lines = stg.co_located("stg_order_line_items") if hasattr(stg, "co_located") else stg["stg_order_line_items"]
    by = [c for c in lines.columns if c in ("order_id", "order_num")]  # the number follows from the id
    first = ("id", "title", "variant_title", "sku", "quantity")  # what lines are ordered by
    flat = F.struct(*first, *[c for c in lines.columns if c not in (*by, *first, "extracted_at")])
    lists = lines.groupBy(*by).agg(F.sort_array(F.collect_list(flat)).alias("lines"))
    return lists.select(F.col("order_id").alias("id"), _edges(F.transform("lines", lambda r: _line(r.getField))).alias("lineItems"))


def _shipment(c: Field) -> Column:
    tracking = F.struct(c("tracking_number").alias("number"), c("tracking_company").alias("company"), c("tracking_url").alias("url"))
    return F.struct(
        c("id").alias("id"),
        c("status").alias("status"),
        c("shipment_status").alias("displayStatus"),
        c("total_quantity").alias("totalQuantity"),
        _iso(c("created_at")).alias("createdAt"),
        _iso(c("updated_at")).alias("updatedAt"),
        _ref(c("location_id")).alias("location"),
        F.struct(c("service").alias("serviceName")).alias("service"),
        F.when(c("tracking_number").isNotNull(), F.array(tracking)).alias("trackingInfo"),
    )


def fulfillment_documents(src: Sources, stg: Staging) -> DataFrame:
    return stg["stg_fulfillments"].select(F.col("order_id").alias("id"), F.array(_shipment(F.col)).alias("fulfillments"))


def fulfillment_line_documents(src: Sources, stg: Staging) -> DataFrame:
    node = F.struct(
        _ref(F.col("line_item_id")).alias("lineItem"),
        "quantity",
        _bag(F.col("original_total")).alias("originalTotalSet"),
        _bag(F.col("discounted_total")).alias("discountedTotalSet"),
    )
    shipment = F.struct(F.col("fulfillment_id").alias("id"), _edges(F.array(node)).alias("fulfillmentLineItems"))
    return _made(src, "stg_fulfillment_line_items").select(F.array(shipment).alias("fulfillments"))


def _refund(c: Field) -> Column:
    return F.struct(
        c("id").alias("id"), _iso(c("created_at")).alias("createdAt"), c("note").alias("note"), _bag(c("total_refunded")).alias("totalRefundedSet")
    )


def refund_documents(src: Sources, stg: Staging) -> DataFrame:
    return stg["stg_refunds"].select(F.col("order_id").alias("id"), F.array(_refund(F.col)).alias("refunds"))


def refund_line_documents(src: Sources, stg: Staging) -> DataFrame:
    node = F.struct(
        "quantity",
        F.col("restock_type").alias("restockType"),
        _ref(F.col("line_item_id")).alias("lineItem"),
        _ref(F.col("location_id")).alias("location"),
        _bag(F.col("subtotal_amount")).alias("subtotalSet"),
        _bag(F.col("total_tax_amount")).alias("totalTaxSet"),
    )
    refund = F.struct(F.col("refund_id").alias("id"), _edges(F.array(node)).alias("refundLineItems"))
    return _made(src, "stg_refund_line_items").select(F.array(refund).alias("refunds"))


def customer_documents(src: Sources, stg: Staging) -> DataFrame:
    return stg["stg_customers"].select(
        "id",
        F.col("first_name").alias("firstName"),
        F.col("last_name").alias("lastName"),
        F.struct(F.col("email").alias("emailAddress"), F.col("email_marketing_state").alias("marketingState")).alias(
            "defaultEmailAddress"
        ),
        F.struct(F.col("phone").alias("phoneNumber"), F.col("sms_marketing_state").alias("marketingState")).alias(
            "defaultPhoneNumber"
        ),
        _iso(F.col("created_at")).alias("createdAt"),
        _iso(F.col("updated_at")).alias("updatedAt"),
        F.col("number_of_orders").cast("string").alias("numberOfOrders"),
        F.struct(F.col("amount_spent").cast("string").alias("amount")).alias("amountSpent"),
        F.from_json("default_address_json", _ADDRESS).alias("defaultAddress"),
        F.split("tags", ",").alias("tags"),
        "note",
        F.col("tax_exempt").alias("taxExempt"),
    )


def product_documents(src: Sources, stg: Staging) -> DataFrame:
    return stg["stg_products"].select(
        "id",
        "title",
        "handle",
        "description",
        F.col("product_type").alias("productType"),
        "vendor",
        "status",
        _iso(F.col("created_at")).alias("createdAt"),
        _iso(F.col("updated_at")).alias("updatedAt"),
        _iso(F.col("published_at")).alias("publishedAt"),
        F.split("tags", ",").alias("tags"),
    )


def variant_documents(src: Sources, stg: Staging) -> DataFrame:
    options = F.array(
        *[F.struct(F.lit(name).alias("name"), F.col(f"option{i}").alias("value")) for i, name in ((1, "Size"), (2, "Color"), (3, "Material"))]
    )
    weight = F.struct(F.struct(F.col("weight").cast("double").alias("value"), F.col("weight_unit").alias("unit")).alias("weight"))
    return stg["stg_product_variants"].select(
        "id",
        "title",
        "sku",
        "barcode",
        F.col("price").cast("string").alias("price"),
        F.col("compare_at_price").cast("string").alias("compareAtPrice"),
        "taxable",
        _iso(F.col("created_at")).alias("createdAt"),
        _iso(F.col("updated_at")).alias("updatedAt"),
        _ref(F.col("product_id")).alias("product"),
        options.alias("selectedOptions"),
        F.struct(
            F.col("inventory_item_id").alias("id"),
            F.col("requires_shipping").alias("requiresShipping"),
            F.struct(F.col("cost").cast("string").alias("amount")).alias("unitCost"),
            weight.alias("measurement"),
        ).alias("inventoryItem"),
    )


def location_documents(src: Sources, stg: Staging) -> DataFrame:
    return stg["stg_locations"].select(
        "id",
        "name",
        F.col("is_active").alias("isActive"),
        F.col("fulfills_online_orders").alias("fulfillsOnlineOrders"),
        F.struct(
            "address1",
            "address2",
            "city",
            "province",
            F.col("province_code").alias("provinceCode"),
            "country",
            F.col("country_code").alias("countryCode"),
            "zip",
            "phone",
        ).alias("address"),
    )


def inventory_documents(src: Sources, stg: Staging, day: str) -> DataFrame:
    quantities = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(name).alias("quantity"))
            for name in ("available", "on_hand", "committed", "incoming", "reserved")
        ]
    )
    level = F.struct(
        _iso(F.col("updated_at")).alias("updatedAt"), _ref(F.col("location_id")).alias("location"), quantities.alias("quantities")
    )
    of_day = stg["stg_inventory_levels"].filter(F.col("snapshot_date") == F.lit(day).cast("date"))
    return of_day.select(F.col("inventory_item_id").alias("id"), _edges(F.array(level)).alias("inventoryLevels"))


def checkout_documents(src: Sources, stg: Staging) -> DataFrame:
    entries = F.from_json("line_items_json", "array<struct<title: string, quantity: int>>")
    return stg["stg_abandoned_checkouts"].select(
        "id",
        _iso(F.col("created_at")).alias("createdAt"),
        _iso(F.col("updated_at")).alias("updatedAt"),
        _iso(F.col("completed_at")).alias("completedAt"),
        F.col("abandoned_checkout_url").alias("abandonedCheckoutUrl"),
        _ref(F.col("customer_id")).alias("customer"),
        _bag(F.col("subtotal_price")).alias("subtotalPriceSet"),
        _bag(F.col("total_tax")).alias("totalTaxSet"),
        _bag(F.col("total_price"), F.col("currency_code")).alias("totalPriceSet"),
        _edges(F.coalesce(entries, F.array())).alias("lineItems"),
    )


def bulk_lines(src: Sources, stg: Staging) -> DataFrame:
    """A bulk export of the orders as (value): orders with their nested lists, then the entries of their connections as lines.

    Lines name their parent, so only the discounts, which are numbered by their places, need an order among themselves: they get
    it as narrow rows. Text is written where it is made and is never shuffled, and lists meet their orders as flat rows, in the
    buckets of the order's number.
    """
    headers = _numbered_documents(src, stg)

    def with_list(orders: DataFrame, table: str, name: str, made: Callable[[Field], Column]) -> DataFrame:
        children = _placed(stg, table).drop("extracted_at")
        entry = F.struct(*[c for c in children.columns if c not in ("order_id", NUMBER)])
        lists = children.groupBy(NUMBER).agg(F.collect_list(entry).alias(name))
        return orders.join(lists, NUMBER, "left").withColumn(name, F.transform(name, lambda r: made(r.getField)))

    nested = headers.drop("discountApplications", "shippingLines")
    nested = with_list(with_list(nested, "stg_fulfillments", "fulfillments", _shipment), "stg_refunds", "refunds", _refund)

    def entries(pages: DataFrame, connection: str, ordered: bool = False) -> DataFrame:
        rows = pages.select("id", F.posexplode(f"{connection}.edges").alias("pos", "e"))
        if ordered:
            rows = rows.repartition("id").sortWithinPartitions("id", "pos")
        return rows.select(F.to_json(F.struct("e.node.*", F.col("id").alias("__parentId"))).alias("value"))

    def inner(pages: DataFrame, outer: str, connection: str) -> DataFrame:
        return entries(pages.select(F.explode(outer).alias("p")).select("p.id", f"p.{connection}"), connection)

    parts = [
        nested.select(F.to_json(F.struct(*[c for c in nested.columns if c != NUMBER])).alias("value")),
        entries(line_documents(src, stg), "lineItems"),
        entries(headers, "discountApplications", ordered=True),
        entries(headers, "shippingLines"),
        inner(fulfillment_line_documents(src, stg), "fulfillments", "fulfillmentLineItems"),
        inner(refund_line_documents(src, stg), "refunds", "refundLineItems"),
    ]
    return reduce(DataFrame.unionByName, parts)
