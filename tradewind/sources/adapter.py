"""Staging tables derived from the generated TPC-H-like tables.

Every rule is a function of the row's own keys, so the same rows come out at any
scale and in any engine. Money is cast to decimals before it is multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.relational import align

Sources = Mapping[str, DataFrame]

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
EXTRACTED_AT = "2001-12-31 00:00:00"
SNAPSHOTS = ("2001-01-01", "2001-11-30", "2001-12-31")


class BaseTables(dict):
    """The generated tables of one folder, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        if name not in BASE_TABLES:
            raise KeyError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self[name] = df
        return df


#: Moves narrow rows, by an order's number as text, to where the rows derived from them will lie.
Deal = Callable[[DataFrame, Column], DataFrame]


# --- small helpers ------------------------------------------------------------
def gid(kind: str, number: Column) -> Column:
    return F.concat(F.lit(f"gid://store/{kind}/"), number.cast("string"))


def pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def cents(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def rate(c: Column | str) -> Column:
    return (F.lit(c) if isinstance(c, str) else c).cast("decimal(4,2)")


def stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def after(ts: Column, days: Column | int = 0, hours: int = 0, mins: int = 0, secs: Column | int = 0) -> Column:
    parts = [F.lit(p) if isinstance(p, int) else p.cast("int") for p in (days, hours, mins)]
    return ts + F.make_dt_interval(*parts, F.lit(secs) if isinstance(secs, int) else secs)


def cycle(n: Column, labels: list[str | None]) -> Column:
    """Label number ``n mod len(labels)``."""
    out = F.lit(None).cast("string")
    for i, label in enumerate(labels):
        if label is not None:
            out = F.when(n % len(labels) == i, F.lit(label)).otherwise(out)
    return out


def numbered(df: DataFrame, count: Column) -> DataFrame:
    """``count`` copies of each row, numbered 1.. in column ``i``; none when it is 0."""
    return df.withColumn("i", F.explode(F.when(count > 0, F.sequence(F.lit(1), count.cast("int")))))


def _voucher_code(k: Column) -> Column:
    return F.concat(F.lit("VC"), pad(k, 14))


def order_time(key: Column, day: Column) -> Column:
    return after(day, secs=(key * 7919) % 86400)


# --- line grain ---------------------------------------------------------------
def _lines(src: Sources) -> DataFrame:
    """Line items with their derived ids and decimal amounts."""
    return _derived(src["lineitem"])


def _derived(li: DataFrame) -> DataFrame:
    gross = cents(F.col("l_extendedprice"))
    discount = F.round(gross * rate(F.col("l_discount")), 2).cast("decimal(18,2)")
    return li.select(
        "*",
        F.col("l_quantity").cast("int").alias("qty"),
        gross.alias("gross"),
        discount.alias("discount"),
        (gross - discount).cast("decimal(18,2)").alias("net"),
        F.round((gross - discount) * rate(F.col("l_tax")), 2).cast("decimal(18,2)").alias("tax"),
        gid(
            "LineItem",
            F.concat(
                pad(F.col("l_orderkey"), 10),
                pad(F.col("l_linenumber"), 2),
                pad(F.col("l_partkey"), 9),
                pad(F.col("l_suppkey"), 8),
                pad((gross * 100).cast("bigint"), 12),
            ),
        ).alias("line_id"),
    )


def _order_of_line(k: Column) -> Column:
    """The number of a line's order; every 499th line names an order that is missing."""
    return F.when((k + F.col("l_linenumber")) % 499 == 0, F.concat(F.lit("9"), pad(k, 12))).otherwise(k.cast("string"))


def order_line_items(src: Sources, deal: Deal = lambda rows, order: rows) -> DataFrame:
    k, p, q = F.col("l_orderkey"), F.col("l_partkey"), F.col("qty")
    variant = F.when(p % 97 == 0, None).when(p % 89 == 5, gid("ProductVariant", F.concat(F.lit("8"), pad(p, 12))))
    open_units = (
        F.when(F.col("l_linestatus") == "O", q).when(q > 40, 1).otherwise(0)
    )
    return _derived(deal(src["lineitem"], _order_of_line(k))).select(
        F.col("line_id").alias("id"),
        gid("Order", _order_of_line(k)).alias("order_id"),
        variant.otherwise(gid("ProductVariant", p)).alias("variant_id"),
        F.when(p % 97 != 0, gid("Product", F.floor(p / 4))).alias("product_id"),
        F.concat(F.lit("Item "), p).alias("title"),
        F.when(p % 4 == 0, "Default Title").otherwise(F.concat(F.lit("Option "), p % 4)).alias("variant_title"),
        F.when(p % 61 != 0, F.concat(F.lit("SKU-"), p)).alias("sku"),
        q.alias("quantity"),
        F.when(k % 83 == 0, None)
        .when(F.col("l_returnflag") == "R", 0)
        .when(F.col("l_returnflag") == "A", q - 1)
        .otherwise(q)
        .alias("current_quantity"),
        open_units.alias("unfulfilled_quantity"),
        F.round(F.col("gross") / q.cast("decimal(10,0)"), 2).cast("decimal(18,2)").alias("unit_price"),
        F.col("gross").alias("total_price"),
        F.col("discount").alias("total_discount"),
        F.col("net").alias("discounted_total"),
        (p % 200 == 7).alias("is_gift_card"),
        (p % 10 != 9).alias("taxable"),
        (p % 200 != 7).alias("requires_shipping"),
        open_units.alias("fulfillable_quantity"),
        stamp(EXTRACTED_AT).alias("extracted_at"),
    )


# --- order grain --------------------------------------------------------------
def _line_sums(src: Sources) -> DataFrame:
    return (
        _lines(src)
        .groupBy(F.col("l_orderkey").cast("string").alias("key"))
        .agg(
            F.sum("net").cast("decimal(18,2)").alias("subtotal"),
            F.sum("discount").cast("decimal(18,2)").alias("discounts"),
            F.sum("tax").cast("decimal(18,2)").alias("taxes"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("net"))).cast("decimal(18,2)").alias("returned"),
        )
    )


def _order_total(k: Column) -> Column:
    return F.when(k % 101 == 0, F.lit(0).cast("decimal(18,2)")).otherwise(cents(F.col("o_totalprice")))


def _refund_total(k: Column, returned: Column, total: Column) -> Column:
    """Refund amounts around the full-refund limit; NULL without returned lines."""
    share = (
        F.when(k % 8 == 0, total)
        .when(k % 8 == 1, F.round(total * rate("0.99"), 2))
        .when(k % 8 == 2, F.round(total * F.lit("0.9899").cast("decimal(6,4)"), 2))
        .when(k % 8 == 3, F.lit(0).cast("decimal(18,2)"))
        .otherwise(F.least(returned, total))
    )
    return F.when(returned.isNotNull(), share).cast("decimal(18,2)")


def _customer_id(k: Column, customer: Column) -> Column:
    return F.when((k % 50 != 0) & (customer % 17 != 16), gid("Customer", customer))


def _address(k: Column, city: Column) -> Column:
    nation = F.col("n_nationkey")
    code = F.when(nation % 5 == 0, "ZA").otherwise(F.concat(F.lit("N"), nation))
    return F.to_json(
        F.struct(
            F.concat(nation, F.lit(" Main Road")).alias("address1"),
            city.alias("city"),
            F.when(k % 47 != 0, F.col("r_name")).alias("province"),
            F.substring("r_name", 1, 2).alias("provinceCode"),
            code.alias("countryCodeV2"),
            F.col("n_name").alias("country"),
            pad(nation, 4).alias("zip"),
        )
    )


def _shipping_fee(k: Column, i: Column) -> Column:
    return (F.lit(50) + i * 10 - k % 5).cast("decimal(18,2)")


def orders(src: Sources, deal: Deal = lambda rows, order: rows) -> DataFrame:
    k = F.col("o_orderkey")
    people = (
        src["customer"]
        .join(src["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(src["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "c_mktsegment", "n_nationkey", "n_name", "r_name")
    )
    known = src["orders"].join(people, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn("num", k.cast("string"))
    # dealt before the sums, which meet them there
    full = deal(known, F.col("num")).join(_line_sums(src), F.col("num") == F.col("key"), "left")
    created = order_time(k, F.col("o_orderdate"))
    status = F.col("o_orderstatus")
    total = _order_total(k)
    segment = F.col("c_mktsegment")
    ship_city = (
        F.when(k % 31 == 0, "").when(k % 43 == 0, F.concat(F.lit('The "Old" '), segment)).otherwise(segment)
    )
    bill_city = F.when(k % 6 == 0, F.concat(F.lit("Billing "), segment)).otherwise(ship_city)
    tags = F.filter(
        F.array(F.when(k % 9 == 0, F.lit("VIP")), F.when(k % 7 == 0, F.lit("B2B")), F.when(k % 13 == 0, F.lit("GIFT"))),
        lambda t: t.isNotNull(),
    )
    fees = F.when(k % 3 == 0, F.lit(0)).when(k % 3 == 1, 60 - k % 5).otherwise(130 - (k % 5) * 2)
    return align(
        full.select(
            gid("Order", k).alias("id"),
            F.concat(F.lit("#"), k).alias("name"),
            F.when(k % 10 != 3, F.concat(F.lit("buyer"), F.col("o_custkey"), F.lit("@example.com"))).alias("email"),
            created.alias("created_at"),
            after(created, mins=5).alias("processed_at"),
            after(created, days=k % 10).alias("updated_at"),
            F.when(k % 37 == 0, after(created, days=1)).alias("cancelled_at"),
            F.when(status == "F", after(created, days=30)).alias("closed_at"),
            F.when(k % 37 == 0, cycle(k, ["CUSTOMER", "INVENTORY", "FRAUD"])).alias("cancel_reason"),
            F.when(k % 20 == 0, "USD").otherwise("ZAR").alias("currency_code"),
            F.coalesce("subtotal", F.lit(0)).alias("subtotal_price"),
            F.coalesce("discounts", F.lit(0)).alias("total_discounts"),
            F.coalesce("taxes", F.lit(0)).alias("total_tax"),
            fees.alias("total_shipping"),
            total.alias("total_price"),
            _refund_total(k, F.col("returned"), total).alias("total_refunded"),
            F.when(k % 41 == 0, "REFUNDED")
            .when(status == "F", "PAID")
            .when(status == "P", "PARTIALLY_REFUNDED")
            .otherwise("PENDING")
            .alias("financial_status"),
            F.when(status == "F", "FULFILLED")
            .when((status == "P") & (k % 2 == 0), "PARTIAL")
            .when(status == "P", "PARTIALLY_FULFILLED")
            .otherwise("UNFULFILLED")
            .alias("fulfillment_status"),
            _customer_id(k, F.col("o_custkey")).alias("customer_id"),
            F.when(k % 29 != 0, _address(k, ship_city)).alias("shipping_address_json"),
            F.when(k % 53 != 0, _address(k, bill_city)).alias("billing_address_json"),
            F.when(F.size(tags) > 0, F.concat_ws(",", tags)).alias("tags"),
            F.when(k % 17 == 0, 'Leave at "door", please').alias("note"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "web")
            .when(F.col("o_orderpriority") == "2-HIGH", "pos")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "mobile")
            .when(F.col("o_orderpriority") == "5-LOW", "marketplace")
            .alias("source_name"),
            F.when(k % 8 == 0, F.lit(None))
            .when(k % 8 < 3, F.concat(F.lit("https://shop.example.com/products/p"), k % 5, F.lit("?ref=mail")))
            .when(k % 8 < 6, F.concat(F.lit("/collections/c"), k % 3))
            .otherwise("https://shop.example.com")
            .alias("landing_site"),
            F.when(k % 5 == 0, F.lit(None))
            .when(k % 5 < 3, F.concat(F.lit("https://search"), k % 2, F.lit(".example.org/find?q=x")))
            .otherwise("https://news.example.net/story")
            .alias("referring_site"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_orders",
    )


def _children(src: Sources, table: str, count: Column, fields: Mapping[str, Column]) -> DataFrame:
    """``count`` child rows per order, each a function of the order row and the number ``i``."""
    named = [c.alias(name) for name, c in fields.items()]
    rows = numbered(src["orders"], count).select(
        gid("Order", F.col("o_orderkey")).alias("order_id"), *named, stamp(EXTRACTED_AT).alias("extracted_at")
    )
    return align(rows, table)


def transaction_count(k: Column) -> Column:
    return k % 5


def transaction_fields(k: Column, i: Column) -> dict[str, Column]:
    paid_at = order_time(k, F.col("o_orderdate")) + F.make_dt_interval(mins=F.least(i, F.lit(3)))
    failed = (k + i) % 7 == 0
    return {
        "id": gid("Transaction", k * 10 + i),
        "kind": F.when((k + i) % 11 == 0, "REFUND").otherwise("SALE"),
        "status": F.when(failed, "FAILURE").otherwise("SUCCESS"),
        "gateway": cycle(k + i, ["gift_card", "payfast", "payflex", "card_payments", "manual"]),
        "amount": F.round(cents(F.col("o_totalprice")) * rate("0.25"), 2),
        "currency_code": F.when(k % 20 == 0, "USD").otherwise("ZAR"),
        "created_at": paid_at,
        "processed_at": after(paid_at, secs=30),
        "error_code": F.when(failed, "CARD_DECLINED"),
    }


def order_transactions(src: Sources) -> DataFrame:
    k, i = F.col("o_orderkey"), F.col("i")
    return _children(src, "stg_order_transactions", transaction_count(k), transaction_fields(k, i))


def tax_line_count(k: Column) -> Column:
    return F.when(k % 97 == 0, 3).otherwise(1 + k % 2)


def tax_line_fields(k: Column, i: Column) -> dict[str, Column]:
    tax_rate = F.when(i == 1, "0.15").when(i == 2, "0.02").otherwise("0.01")
    return {
        "line_number": i,
        "title": F.when(i == 1, "VAT").when(i == 2, "Environmental Levy").otherwise("Duty"),
        "rate": tax_rate,
        "price": F.round(cents(F.col("o_totalprice")) * rate(tax_rate), 2),
    }


def order_tax_lines(src: Sources) -> DataFrame:
    k, i = F.col("o_orderkey"), F.col("i")
    return _children(src, "stg_order_tax_lines", tax_line_count(k), tax_line_fields(k, i))


def discount_count(k: Column) -> Column:
    return F.when(k % 3 == 0, 0).when(k % 4 == 1, 2).otherwise(1)


def discount_fields(k: Column, i: Column) -> dict[str, Column]:
    code = (
        F.when((k % 4 == 2) & (i == 1), _voucher_code(k))
        .when((k % 20 == 3) & (i == 1), _voucher_code(k - 1))
        .when((k + i) % 3 != 1, F.concat(cycle(k, ["PROMO-", "STAFF-", "WELCOME-"]), pad(k % 12, 2)))
    )
    percentage = (k + i) % 2 == 0
    return {
        "line_number": i,
        "discount_type": F.when(code.isNotNull(), "DiscountCodeApplication").otherwise("ManualDiscountApplication"),
        "code": code,
        "title": F.when(code.isNull(), "Goodwill"),
        "description": F.when(code.isNull(), "Manual adjustment"),
        "value_type": F.when(percentage, "PricingPercentageValue").otherwise("MoneyV2"),
        "value_amount": F.when(~percentage, (k % 500).cast("decimal(18,2)") + F.lit("0.99").cast("decimal(4,2)")),
        "value_percentage": F.when(percentage, (k % 50).cast("decimal(5,2)") + F.lit("0.50").cast("decimal(4,2)")),
        "target_type": F.lit("LINE_ITEM"),
        "allocation_method": F.lit("ACROSS"),
    }


def order_discount_applications(src: Sources) -> DataFrame:
    k, i = F.col("o_orderkey"), F.col("i")
    return _children(src, "stg_order_discount_applications", discount_count(k), discount_fields(k, i))


def shipping_line_count(k: Column) -> Column:
    return k % 3


def shipping_line_fields(k: Column, i: Column) -> dict[str, Column]:
    return {
        "id": gid("ShippingLine", k * 10 + i),
        "title": cycle(k + i, ["Standard Shipping", "Express Overnight", "Click and Collect"]),
        "code": cycle(k + i, ["STD", "EXP", "CNC"]),
        "source": F.lit("rates"),
        "original_price": (50 + i * 10).cast("decimal(18,2)"),
        "discounted_price": _shipping_fee(k, i),
        "carrier_identifier": cycle(k + i, ["standard", "express", "pickup", None]),
    }


def order_shipping_lines(src: Sources) -> DataFrame:
    k, i = F.col("o_orderkey"), F.col("i")
    return _children(src, "stg_order_shipping_lines", shipping_line_count(k), shipping_line_fields(k, i))


# --- fulfilment and refund grain ----------------------------------------------
def _fulfillment_id(order: Column, supplier: Column) -> Column:
    return gid("Fulfillment", F.concat(pad(order, 10), pad(supplier, 8)))


def fulfillments(src: Sources, deal: Deal = lambda rows, order: rows) -> DataFrame:
    k, s = F.col("l_orderkey"), F.col("l_suppkey")
    lines = src["lineitem"].filter(F.col("l_linestatus") == "F").withColumn("num", k.cast("string"))
    shipped = (
        deal(lines, F.col("num"))  # grouped and joined where they will lie
        .groupBy("num", "l_orderkey", "l_suppkey")
        .agg(F.min("l_shipdate").alias("first_ship"), F.sum(F.col("l_quantity").cast("int")).alias("units"))
    )
    placed = src["orders"].select(F.col("o_orderkey").cast("string").alias("num"), order_time(F.col("o_orderkey"), F.col("o_orderdate")).alias("placed"))
    at = F.col("placed")
    created = (
        F.when(s % 6 == 0, after(at, hours=23, mins=54))
        .when(s % 6 == 1, after(at, hours=24))
        .when(s % 6 == 2, after(at, hours=48))
        .when(s % 6 == 3, after(at, hours=72, mins=6))
        .when(s % 6 == 4, after(at, hours=-1))
        .otherwise(F.col("first_ship"))
    )
    tracked = (k + s) % 4 != 0
    return align(
        shipped.join(placed, "num").select(
            _fulfillment_id(k, s).alias("id"),
            gid("Order", k).alias("order_id"),
            F.when(k % 9 == 0, "PENDING").when(k % 21 == 1, "CANCELLED").otherwise("SUCCESS").alias("status"),
            created.alias("created_at"),
            after(created, days=1).alias("updated_at"),
            F.when(tracked, F.concat(F.lit("TRK"), k, F.lit("-"), s)).alias("tracking_number"),
            F.when(tracked, cycle(s, ["Courier One", "Courier Two"])).alias("tracking_company"),
            F.when(tracked, F.concat(F.lit("https://track.example.com/"), k, F.lit("/"), s)).alias("tracking_url"),
            F.when(k % 23 != 0, gid("Location", s)).alias("location_id"),
            F.lit("manual").alias("service"),
            cycle(k, ["DELIVERED", "IN_TRANSIT", None]).alias("shipment_status"),
            F.col("units").alias("total_quantity"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_fulfillments",
    )


def fulfillment_line_items(src: Sources) -> DataFrame:
    return align(
        _lines(src)
        .filter(F.col("l_linestatus") == "F")
        .select(
            _fulfillment_id(F.col("l_orderkey"), F.col("l_suppkey")).alias("fulfillment_id"),
            F.col("line_id").alias("line_item_id"),
            F.col("qty").alias("quantity"),
            F.col("gross").alias("original_total"),
            F.col("net").alias("discounted_total"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_fulfillment_line_items",
    )


def refunds(src: Sources, deal: Deal = lambda rows, order: rows) -> DataFrame:
    k = F.col("o_orderkey")
    returned = (
        _lines(src)
        .filter(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_orderkey").cast("string").alias("key"))
        .agg(F.sum("net").cast("decimal(18,2)").alias("returned"))
    )
    orders = deal(src["orders"].withColumn("num", k.cast("string")), F.col("num"))
    return align(
        orders.join(returned, F.col("num") == F.col("key")).select(
            gid("Refund", k).alias("id"),
            gid("Order", k).alias("order_id"),
            after(order_time(k, F.col("o_orderdate")), days=k % 60).alias("created_at"),
            F.when(k % 5 == 0, "Damaged").alias("note"),
            _refund_total(k, F.col("returned"), _order_total(k)).alias("total_refunded"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_refunds",
    )


def refund_line_items(src: Sources) -> DataFrame:
    p = F.col("l_partkey")
    # A refund hangs off its order, so lines of a missing order have none.
    known = src["orders"].select("o_orderkey")
    return align(
        _lines(src)
        .filter(F.col("l_returnflag") == "R")
        .join(known, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        .select(
            gid("Refund", F.col("l_orderkey")).alias("refund_id"),
            F.col("line_id").alias("line_item_id"),
            F.col("qty").alias("quantity"),
            cycle(p, ["RETURN", "CANCEL", "NO_RESTOCK", "LEGACY_RESTOCK"]).alias("restock_type"),
            F.when(p % 3 != 0, gid("Location", F.col("l_suppkey"))).alias("location_id"),
            F.col("net").alias("subtotal_amount"),
            F.col("tax").alias("total_tax_amount"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_refund_line_items",
    )


# --- master data --------------------------------------------------------------
def customers(src: Sources) -> DataFrame:
    k = F.col("c_custkey")
    address = F.to_json(
        F.struct(
            F.col("c_mktsegment").alias("city"),
            F.col("n_name").alias("country"),
            pad(F.col("n_nationkey"), 4).alias("zip"),
        )
    )
    created = after(stamp("1994-06-01 08:00:00"), days=k % 2000)
    return align(
        src["customer"]
        .join(src["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            gid("Customer", k).alias("id"),
            F.when(k % 10 != 3, F.concat(F.lit("buyer"), k, F.lit("@example.com"))).alias("email"),
            F.when(k % 3 != 0, F.concat(F.lit("+27"), pad(k, 9))).alias("phone"),
            F.when(k % 7 != 0, F.concat(F.lit("First"), k)).alias("first_name"),
            F.when(k % 14 != 0, F.col("c_name")).alias("last_name"),
            cycle(k, ["SUBSCRIBED", "PENDING", "UNSUBSCRIBED", None]).alias("email_marketing_state"),
            cycle(k, ["NOT_SUBSCRIBED", "SUBSCRIBED", None]).alias("sms_marketing_state"),
            created.alias("created_at"),
            after(created, days=k % 30).alias("updated_at"),
            (k % 9).alias("number_of_orders"),
            cents(F.col("c_acctbal")).alias("amount_spent"),
            F.when(k % 19 != 0, address).alias("default_address_json"),
            cycle(
                k,
                ["SB-Platinum", "newsletter,SB-Gold", "SB-Silver,wholesale", "VIP", "wholesale"] + [None] * 5,
            ).alias("tags"),
            F.when(k % 12 == 0, "Prefers email").alias("note"),
            (k % 25 == 0).alias("tax_exempt"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_customers",
    )


def products(src: Sources) -> DataFrame:
    """Every fourth part is a product; the parts after it are its variants."""
    n = F.floor(F.col("p_partkey") / 4)
    created = after(stamp("1994-01-01 00:00:00"), days=n % 1500, secs=n % 86400)
    status = F.when(n % 10 == 0, "DRAFT").when(n % 10 == 1, "ARCHIVED").otherwise("ACTIVE")
    return align(
        src["part"]
        .filter((F.col("p_partkey") % 4 == 0) & (n % 151 != 150))
        .select(
            gid("Product", n).alias("id"),
            F.concat(F.col("p_name"), F.lit(" "), n).alias("title"),
            F.concat(F.lit("product-"), n).alias("handle"),
            F.concat(F.lit("Type "), F.col("p_type")).alias("description"),
            F.col("p_type").alias("product_type"),
            F.col("p_brand").alias("vendor"),
            status.alias("status"),
            created.alias("created_at"),
            after(created, days=1).alias("updated_at"),
            F.when(status != "DRAFT", after(created, days=2)).alias("published_at"),
            F.when(n % 3 == 0, "new,sale").when(n % 3 == 1, F.col("p_type")).alias("tags"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_products",
    )


def product_variants(src: Sources) -> DataFrame:
    p = F.col("p_partkey")
    price = cents(F.col("p_retailprice"))
    created = after(stamp("1994-02-01 00:00:00"), days=p % 1500)
    return align(
        src["part"].select(
            gid("ProductVariant", p).alias("id"),
            gid("Product", F.floor(p / 4)).alias("product_id"),
            F.when(p % 50 == 1, None)
            .when(p % 4 == 0, "Default Title")
            .otherwise(F.concat(F.lit("Option "), p % 4))
            .alias("title"),
            F.when(p % 61 != 0, F.concat(F.lit("SKU-"), p)).alias("sku"),
            F.when(p % 7 != 0, pad(p, 13)).alias("barcode"),
            price.alias("price"),
            F.when(p % 3 == 0, F.round(price * rate("1.20"), 2)).when(p % 3 == 1, price).alias("compare_at_price"),
            F.when(p % 11 != 0, F.round(price * rate("0.60"), 2)).alias("cost"),
            (p % 10 != 9).alias("taxable"),
            (p % 200 != 7).alias("requires_shipping"),
            (F.col("p_size").cast("decimal(10,2)") + F.lit("0.25").cast("decimal(4,2)")).alias("weight"),
            cycle(p, ["GRAMS", "Kilograms", "POUNDS", "OUNCES", None]).alias("weight_unit"),
            F.col("p_brand").alias("option1"),
            F.when(p % 2 == 0, F.col("p_type")).alias("option2"),
            F.when(p % 4 == 0, F.col("p_name")).alias("option3"),
            gid("InventoryItem", p).alias("inventory_item_id"),
            created.alias("created_at"),
            after(created, days=3).alias("updated_at"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_product_variants",
    )


def locations(src: Sources) -> DataFrame:
    s = F.col("s_suppkey")
    nation = F.col("n_nationkey")
    return align(
        src["supplier"]
        .join(src["nation"], F.col("s_nationkey") == nation, "left")
        .select(
            gid("Location", s).alias("id"),
            F.col("s_name").alias("name"),
            F.when(s % 8 != 0, F.concat(s, F.lit(" Depot Street"))).alias("address1"),
            F.when(s % 3 == 0, F.concat(F.lit("Unit "), s)).alias("address2"),
            F.concat(F.lit("City "), nation).alias("city"),
            F.when(s % 5 != 0, F.concat(F.lit("Province "), nation % 5)).alias("province"),
            F.when(s % 5 != 0, F.concat(F.lit("P"), nation % 5)).alias("province_code"),
            F.col("n_name").alias("country"),
            F.when(nation % 5 == 0, "ZA").otherwise(F.concat(F.lit("N"), nation)).alias("country_code"),
            pad(nation, 4).alias("zip"),
            (s % 13 != 0).alias("is_active"),
            (s % 2 == 0).alias("fulfills_online_orders"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_locations",
    )


def inventory_levels(src: Sources) -> DataFrame:
    """Two depots per part on three snapshot days, with stock around the flag limits."""
    p, j, d = F.col("p_partkey"), F.col("j"), F.col("d")
    depots = src["supplier"].agg(F.count(F.lit(1))).scalar()
    grid = (
        src["part"]
        .withColumn("j", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("d", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    )
    n = p + j + d
    available = (
        F.when(n % 7 == 1, 0)
        .when(n % 7 == 2, 9)
        .when(n % 7 == 3, 10)
        .when(n % 7 == 4, 500)
        .when(n % 7 == 5, 501)
        .when(n % 7 == 6, F.col("p_size"))
    )
    depot = F.when(p % 70 == 0, F.lit(777777777) + j).otherwise((p + j * 3) % depots)
    day = F.element_at(F.array(*map(F.lit, SNAPSHOTS)), d + 2)
    return align(
        grid.select(
            gid("InventoryItem", p).alias("inventory_item_id"),
            gid("Location", depot).alias("location_id"),
            available.alias("available"),
            F.when(n % 13 != 0, F.coalesce(available, F.lit(0)) + p % 5).alias("on_hand"),
            (p % 5).alias("committed"),
            F.when(p % 4 != 3, (p % 4) * 10).alias("incoming"),
            (p % 2).alias("reserved"),
            F.concat(day, F.lit(" 06:00:00")).alias("updated_at"),
            day.alias("snapshot_date"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_inventory_levels",
    )


def abandoned_checkouts(src: Sources) -> DataFrame:
    e = F.col("event_id")
    value = cents(F.col("value"))
    tax = F.round(value * rate("0.15"), 2)
    lines = F.transform(
        F.when(e % 4 > 0, F.sequence(F.lit(1), (e % 4).cast("int"))),
        lambda i: F.struct(F.concat(F.lit("Item "), i).alias("title"), i.alias("quantity")),
    )
    return align(
        src["events"]
        .filter(F.col("event_type").isin("purchase", "click"))
        .select(
            gid("Checkout", e).alias("id"),
            F.col("ts").alias("created_at"),
            after(F.col("ts"), mins=10).alias("updated_at"),
            F.when(F.col("event_type") == "purchase", after(F.col("ts"), hours=1)).alias("completed_at"),
            F.when(e % 6 != 0, gid("Customer", F.col("user_id"))).alias("customer_id"),
            value.alias("subtotal_price"),
            tax.alias("total_tax"),
            (value + tax).alias("total_price"),
            F.lit("ZAR").alias("currency_code"),
            F.concat(F.lit("https://shop.example.com/recover/"), e).alias("abandoned_checkout_url"),
            (e % 4).alias("line_items_count"),
            F.to_json(lines).alias("line_items_json"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_abandoned_checkouts",
    )


def discount_codes(src: Sources) -> DataFrame:
    """One row per code used on an order."""
    used = order_discount_applications(src).filter(F.col("code").isNotNull())
    per_code = used.groupBy("code").agg(F.count(F.lit(1)).alias("uses"))
    digits = F.regexp_substr("code", F.lit("[0-9]+$")).cast("bigint")
    voucher = F.col("code").startswith("VC")
    family = F.when(voucher, 4).when(F.col("code").startswith("PROMO"), 1).when(F.col("code").startswith("STAFF"), 2).otherwise(3)
    percentage = digits % 2 == 0
    return align(
        per_code.select(
            gid("DiscountCode", F.concat(family, pad(digits, 12))).alias("id"),
            "code",
            F.concat(F.lit("Code "), "code").alias("title"),
            F.when(voucher, "DiscountCodeApp").otherwise("DiscountCodeBasic").alias("discount_type"),
            F.when(digits % 5 == 4, "EXPIRED").otherwise("ACTIVE").alias("status"),
            F.when(percentage, "DiscountPercentage").otherwise("MoneyV2").alias("value_type"),
            F.when(~percentage, (digits % 100 + 50).cast("decimal(18,2)")).alias("value_amount"),
            F.when(percentage, (digits % 40 + 5).cast("decimal(5,2)")).alias("value_percentage"),
            F.lit("1995-01-01 00:00:00").alias("starts_at"),
            F.when(digits % 3 == 0, "2000-06-30 00:00:00").alias("ends_at"),
            F.when(digits % 5 != 0, digits % 100 * 10).alias("usage_limit"),
            F.col("uses").alias("usage_count"),
            voucher.alias("applies_once_per_customer"),
            F.lit("1995-01-01 00:00:00").alias("created_at"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_discount_codes",
    )


# --- voucher layer ------------------------------------------------------------
def _vouchers(src: Sources) -> DataFrame:
    """Orders with an even key stand for vouchers: multiples of four are gift cards."""
    k = F.col("o_orderkey")
    return src["orders"].filter(k % 2 == 0).select(
        k.alias("k"),
        "o_custkey",
        _voucher_code(k).alias("voucher_code"),
        (k % 4 == 0).alias("is_card"),
        (F.lit(100) + (k % 9) * 50).cast("decimal(18,2)").alias("face_value"),
        after(F.col("o_orderdate"), days=-(10 + k % 20)).alias("made_at"),
        order_time(k, F.col("o_orderdate")).alias("ordered_at"),
    )


def gift_cards(src: Sources) -> DataFrame:
    k, face = F.col("k"), F.col("face_value")
    balance = F.when(k % 12 == 0, face).when(k % 12 == 4, F.lit(0)).otherwise(F.round(face * rate("0.25"), 2))
    code = F.when(k % 100 == 0, "zzzz").otherwise(F.right("voucher_code", F.lit(4)))
    return align(
        _vouchers(src).filter("is_card").select(
            gid("GiftCard", k).alias("id"),
            code.alias("code"),
            face.alias("initial_value"),
            balance.alias("balance"),
            F.lit("ZAR").alias("currency_code"),
            (k % 24 != 0).alias("enabled"),
            F.date_add(F.col("made_at").cast("date"), 365).alias("expires_on"),
            F.col("made_at").alias("created_at"),
            F.col("ordered_at").alias("updated_at"),
            F.when(k % 12 != 0, gid("Order", k)).alias("order_id"),
            F.when(k % 12 != 0, _customer_id(k, F.col("o_custkey"))).alias("customer_id"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_gift_cards",
    )


def channels(src: Sources) -> DataFrame:
    n = F.col("n_nationkey")
    return align(
        src["nation"].join(src["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.concat(F.lit("CH"), n).alias("channel_id"),
            F.col("n_name").alias("channel_name"),
            F.col("r_name").alias("industry"),
            F.concat(F.lit("Contact "), n).alias("contact_name"),
            F.lit("1995-01-01").alias("contract_start_date"),
            F.when(n % 4 == 0, "2001-06-30").alias("contract_end_date"),
            (n % 4 != 0).alias("is_active"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_channels",
    )


def _channel_id(customer: Column) -> Column:
    return F.concat(F.lit("CH"), customer % 27)


def voucher_inventory(src: Sources) -> DataFrame:
    k = F.col("k")
    return align(
        _vouchers(src).select(
            F.concat(F.lit("V"), k).alias("voucher_id"),
            "voucher_code",
            F.when(F.col("is_card"), "gift_card").otherwise("discount_code").alias("voucher_type"),
            F.when(k % 74 != 0, _channel_id(F.col("o_custkey"))).alias("channel_id"),
            "face_value",
            F.lit("ZAR").alias("currency_code"),
            F.col("made_at").alias("created_in_store_at"),
            F.when(F.col("is_card") & (k % 40 != 0), gid("GiftCard", k))
            .when(~F.col("is_card"), gid("DiscountCode", F.concat(F.lit("4"), pad(k, 12))))
            .alias("store_object_id"),
            F.lit("allocated").alias("status"),
            F.concat(F.lit("B"), k % 100).alias("batch_id"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_voucher_inventory",
    )


def voucher_distributions(src: Sources) -> DataFrame:
    k, i = F.col("k"), F.col("i")
    sent = after(F.col("made_at"), days=2 + k % 7 + i)
    count = F.when(k % 10 == 0, 0).when(k % 50 == 2, 2).otherwise(1)
    by_sms = k % 3 != 0
    subscription = k % 8 < 4
    return align(
        numbered(_vouchers(src), count).select(
            F.concat(F.lit("D"), k, F.lit("-"), i).alias("distribution_id"),
            F.concat(F.lit("V"), k).alias("voucher_id"),
            "voucher_code",
            _channel_id(F.col("o_custkey")).alias("channel_id"),
            F.date_sub(sent.cast("date"), 1).alias("instruction_date"),
            sent.alias("distribution_date"),
            F.when(by_sms, "sms").otherwise("direct_channel").alias("distribution_method"),
            F.when(by_sms, F.concat(F.lit("+27"), pad(k, 9))).alias("recipient_phone"),
            F.when(by_sms, cycle(k, ["delivered", "failed", "delivered", "pending"])).alias("sms_status"),
            subscription.alias("subscription_flag"),
            F.when(subscription, k % 24 + 1).alias("subscription_month"),
            stamp(EXTRACTED_AT).alias("extracted_at"),
        ),
        "stg_voucher_distributions",
    )


def campaign_segments(src: Sources) -> DataFrame:
    k = F.col("k")
    campaign = (
        F.when(k % 30 == 0, "Refund")
        .when(k % 10 == 2, "Subscription 25% 24 Month Virtual")
        .when(k % 10 == 4, "Subscription 50% 36 Month Virtual")
        .when(k % 30 == 6, "In Process")
        .when(k % 30 == 16, "NATION_3")
        .otherwise("Virtual")
    )
    client = (
        F.when(k % 30 == 0, cycle(k, ["Damaged", "Missing items"]))
        .when(k % 30 == 6, "Refund")
        .when(k % 30 == 16, "Refund")
        .when(k % 14 == 0, "Marketing")
        .otherwise(F.concat(F.lit("NATION_"), F.col("o_custkey") % 27))
    )
    return align(
        _vouchers(src).select(
            F.concat(F.lit("S"), k).alias("segment_id"),
            F.col("voucher_code").alias("code"),
            campaign.alias("campaign"),
            client.alias("client"),
            F.when(k % 30 == 16, "Faulty").alias("refund_reason"),
        ),
        "stg_campaign_segments",
    )


def commission_rates(src: Sources) -> DataFrame:
    """Two rate versions per channel, the second open-ended."""
    n, i = F.col("n_nationkey"), F.col("i")
    return numbered(src["nation"], F.lit(2)).select(
        F.concat(F.lit("CH"), n).alias("channel_id"),
        F.lit("commission").alias("rate_type"),
        ((n % 10 + i * 5).cast("decimal(8,4)") / 100).cast("decimal(8,4)").alias("rate_value"),
        F.when(i == 1, "1995-01-01").otherwise("1998-07-01").cast("date").alias("effective_from"),
        F.when(i == 1, F.lit("1998-07-01")).cast("date").alias("effective_to"),
    )


BUILDERS: dict[str, Callable[[Sources], DataFrame]] = {
    "stg_orders": orders,
    "stg_order_line_items": order_line_items,
    "stg_order_transactions": order_transactions,
    "stg_order_tax_lines": order_tax_lines,
    "stg_order_discount_applications": order_discount_applications,
    "stg_order_shipping_lines": order_shipping_lines,
    "stg_fulfillments": fulfillments,
    "stg_fulfillment_line_items": fulfillment_line_items,
    "stg_refunds": refunds,
    "stg_refund_line_items": refund_line_items,
    "stg_customers": customers,
    "stg_products": products,
    "stg_product_variants": product_variants,
    "stg_discount_codes": discount_codes,
    "stg_locations": locations,
    "stg_inventory_levels": inventory_levels,
    "stg_abandoned_checkouts": abandoned_checkouts,
    "stg_gift_cards": gift_cards,
    "stg_channels": channels,
    "stg_voucher_inventory": voucher_inventory,
    "stg_voucher_distributions": voucher_distributions,
    "stg_campaign_segments": campaign_segments,
    "commission_rates": commission_rates,
}
