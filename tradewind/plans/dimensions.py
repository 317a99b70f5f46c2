"""Dimension builds. Each takes the tables it reads and returns one aligned frame."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.scalars import (
    date_key,
    first_match,
    flag,
    full_name,
    id_digits,
    null_if_blank,
    one_of,
    percent_of,
    titled,
    weight_in_grams,
)
from tradewind.operators.addresses import FIELDS, NO_ADDRESS, address_key, parse_addresses
from tradewind.operators.relational import align, with_member
from tradewind.operators.row_index import Numbering, row_index, tile_index

# --- fixed values -------------------------------------------------------------
CALENDAR_START, CALENDAR_END = date(2020, 1, 1), date(2030, 12, 31)
MEMBERSHIP_TIERS = {
    "SB-Platinum": "Standard Bank Platinum",
    "SB-Gold": "Standard Bank Gold",
    "SB-Silver": "Standard Bank Silver",
}
CONSENT_STATES = ("SUBSCRIBED", "PENDING")
DISCOUNT_VALUE_TYPES = {"Percentage": "percentage", "Money": "fixed_amount"}
REGION_OF_COUNTRY = {"ZA": "Southern Africa"}
RFM_TILES = 5


def fiscal_year(day: Column, start_month: int) -> Column:
    """Year in which the fiscal year of ``day`` began."""
    return F.year(day) - F.when(F.month(day) < start_month, 1).otherwise(0)


def fiscal_quarter(day: Column, start_month: int) -> Column:
    return F.floor(F.pmod(F.month(day) - start_month, F.lit(12)) / 3).cast("int") + 1


def dim_date(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END, fiscal_start_month: int = 1
) -> DataFrame:
    day = F.col("full_date")
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    weekday = F.weekday(day) + 1
    return align(
        days.select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("cal_year"),
            F.quarter(day).alias("cal_quarter"),
            F.month(day).alias("cal_month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.weekofyear(day).alias("week_of_year"),
            F.dayofmonth(day).alias("day_of_month"),
            weekday.alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            (weekday >= 6).alias("is_weekend"),
            (F.last_day(day) == day).alias("is_month_end"),
            fiscal_year(day, fiscal_start_month).alias("fiscal_year"),
            fiscal_quarter(day, fiscal_start_month).alias("fiscal_quarter"),
        ),
        "dim_date",
    )


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("id").cast("int")
    hour_12 = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    am_pm = F.when(hour < 12, "AM").otherwise("PM")
    return align(
        spark.range(24).select(
            hour.alias("time_key"),
            hour.alias("hour_24"),
            hour_12.alias("hour_12"),
            am_pm.alias("am_pm"),
            F.concat(hour_12, F.lit(":00 "), am_pm).alias("hour_label"),
            F.when(hour.between(0, 5), "Night")
            .when(hour.between(6, 11), "Morning")
            .when(hour.between(12, 17), "Afternoon")
            .otherwise("Evening")
            .alias("day_part"),
            hour.between(9, 16).alias("is_business_hours"),
        ),
        "dim_time",
    )


def dim_product(products: DataFrame, variants: DataFrame, loaded_at: Column, number: Numbering = row_index) -> DataFrame:
    v, p = variants.alias("v"), products.alias("p")
    pairs = v.join(p, F.col("v.product_id") == F.col("p.id"))
    keyed = number(
        v.select("v.id", "v.product_id")
        .join(p.select(F.col("p.id").alias("product_id")), "product_id", "left_semi")
        .select("id"),
        ["id"],
        "product_key",
    )
    compare, price = F.col("v.compare_at_price"), F.col("v.price")
    on_sale = flag(compare > price)
    built = pairs.join(keyed.alias("k"), F.col("v.id") == F.col("k.id")).select(
        "k.product_key",
        id_digits(F.col("p.id")).alias("product_id"),
        id_digits(F.col("v.id")).alias("variant_id"),
        "v.sku",
        "v.barcode",
        F.col("p.title").alias("product_title"),
        F.col("v.title").alias("variant_title"),
        titled(F.col("p.title"), F.col("v.title")).alias("full_title"),
        "p.product_type",
        "p.vendor",
        F.col("v.option1").alias("option_1_value"),
        F.col("v.option2").alias("option_2_value"),
        F.col("v.option3").alias("option_3_value"),
        price.alias("current_price"),
        compare.alias("compare_at_price"),
        F.col("v.cost").alias("unit_cost"),
        on_sale.alias("is_on_sale"),
        F.when(on_sale, percent_of(compare - price, compare)).alias("discount_percentage"),
        F.col("v.taxable").alias("is_taxable"),
        "v.requires_shipping",
        weight_in_grams(F.col("v.weight"), F.col("v.weight_unit")).alias("weight_grams"),
        F.col("p.status").alias("product_status"),
        "p.tags",
        F.col("p.created_at").cast("date").alias("product_created_date"),
        loaded_at.alias("loaded_at"),
    )
    return with_member(
        align(built, "dim_product"),
        "dim_product",
        product_key=-1,
        product_title="Unknown Product",
        full_title="Unknown Product",
    ).withColumn("loaded_at", loaded_at)


def customer_orders(orders: DataFrame) -> DataFrame:
    """Lifetime order statistics per customer number."""
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy(id_digits(F.col("customer_id")).alias("cust_num"))
        .agg(
            F.count(F.lit(1)).alias("lifetime_order_count"),
            F.sum("total_price").alias("lifetime_revenue"),
            F.min("created_at").cast("date").alias("first_order_date"),
            F.max("created_at").cast("date").alias("last_order_date"),
        )
    )


def lifecycle_segment(order_count: Column, idle_days: Column) -> Column:
    return (
        F.when(order_count == 0, "Prospect")
        .when((idle_days <= 90) & (order_count == 1), "New")
        .when(idle_days <= 90, "Active")
        .when(idle_days <= 180, "At-Risk")
        .otherwise("Lapsed")
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Ten ordered rules; the first that holds names the segment."""
    return (
        F.when(r.isNull(), None)
        .when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 4), "Loyal")
        .when((r >= 4) & (f >= 2), "Potential Loyalists")
        .when((r == 5) & (f == 1), "New Customers")
        .when((r >= 3) & (f <= 2), "Promising")
        .when((r == 3) & (f == 3), "Needs Attention")
        .when((r <= 2) & (f >= 4) & (m >= 4), "At Risk")
        .when((r <= 2) & (f >= 3), "About to Sleep")
        .when((r <= 2) & (f <= 2), "Hibernating")
        .otherwise("Others")
    )


def dim_customer(customers: DataFrame, orders: DataFrame, as_of: date, loaded_at: Column, number: Numbering = row_index) -> DataFrame:
    num = id_digits(F.col("id"))
    history = customers.select(num.alias("cust_num")).join(customer_orders(orders), "cust_num", "left").select(
        "cust_num",
        F.coalesce("lifetime_order_count", F.lit(0)).alias("lifetime_order_count"),
        F.coalesce("lifetime_revenue", F.lit(0)).cast("decimal(18,2)").alias("lifetime_revenue"),
        "first_order_date",
        "last_order_date",
    )
    # Prospects take part in the tiles (NULL dates last) and lose their scores afterwards.
    tiles = {
        "rfm_recency_score": "last_order_date",
        "rfm_frequency_score": "lifetime_order_count",
        "rfm_monetary_score": "lifetime_revenue",
    }

    def ranked(score: str) -> DataFrame:
        measure = tiles[score]
        order = [F.col(measure).asc_nulls_last(), F.col("cust_num")]
        return tile_index(history.select("cust_num", measure), order, RFM_TILES, score).select("cust_num", score)

    with ThreadPoolExecutor(len(tiles) + 1) as pool:  # four independent sorts
        numbers = pool.submit(number, history.select("cust_num"), ["cust_num"], "customer_key")
        scored = history
        for part in pool.map(ranked, tiles):
            scored = scored.join(part, "cust_num")
        scored = scored.join(numbers.result(), "cust_num")

    orders_made = F.col("lifetime_order_count")
    scores = [F.when(orders_made > 0, F.col(name)) for name in tiles]
    idle_days = F.datediff(F.lit(as_of), F.col("last_order_date"))
    built = (
        parse_addresses(customers.withColumn("cust_num", num), "default_address_json", "default_", ("country", "city"))
        .join(scored, "cust_num")
        .select(
            "customer_key",
            F.col("cust_num").alias("customer_id"),
            "email",
            "first_name",
            "last_name",
            full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
            "phone",
            one_of(F.col("email_marketing_state"), CONSENT_STATES).alias("accepts_email_marketing"),
            one_of(F.col("sms_marketing_state"), CONSENT_STATES).alias("accepts_sms_marketing"),
            F.col("created_at").cast("date").alias("customer_created_date"),
            "default_country",
            "default_city",
            "tags",
            first_match(F.col("tags"), MEMBERSHIP_TIERS).alias("membership_tier"),
            F.col("tax_exempt").alias("is_tax_exempt"),
            "lifetime_order_count",
            "lifetime_revenue",
            "first_order_date",
            "last_order_date",
            F.when(orders_made > 0, F.col("lifetime_revenue") / orders_made).alias("average_order_value"),
            idle_days.alias("days_since_last_order"),
            lifecycle_segment(orders_made, idle_days).alias("customer_segment"),
            *[score.alias(name) for score, name in zip(scores, tiles)],
            sum((F.coalesce(score, F.lit(0)) for score in scores[1:]), F.coalesce(scores[0], F.lit(0))).alias(
                "rfm_combined_score"
            ),
            rfm_segment(*scores).alias("rfm_segment"),
        )
    )
    return with_member(
        align(built, "dim_customer"), "dim_customer", customer_key=-1, full_name="Unknown Customer"
    ).withColumn("loaded_at", loaded_at)


def dim_geography(orders: DataFrame, loaded_at: Column, number: Numbering = row_index) -> DataFrame:
    """One row per distinct address, shipping and billing together (one scan)."""
    roles = orders.select(
        F.explode(F.array("shipping_address_json", "billing_address_json")).alias("text")
    ).filter(F.col("text").isNotNull())
    parts = parse_addresses(roles, "text").withColumn("address_hash", address_key())
    distinct = (
        parts.filter(F.col("address_hash") != NO_ADDRESS)
        .groupBy("address_hash")
        .agg(*[F.max(name).alias(name) for name in FIELDS])
    )
    keyed = number(distinct.select("address_hash"), ["address_hash"], "geography_key")
    region = F.lit(None).cast("string")
    for country, name in REGION_OF_COUNTRY.items():
        region = F.when(F.col("country_code") == country, name).otherwise(region)
    built = distinct.join(keyed, "address_hash").withColumn("region", region)
    return with_member(
        align(built, "dim_geography"), "dim_geography", geography_key=-1, address_hash="__unknown__"
    ).withColumn("loaded_at", loaded_at)


def dim_discount(codes: DataFrame, loaded_at: Column, number: Numbering = row_index) -> DataFrame:
    keyed = number(codes.select("id"), ["id"], "discount_key")
    built = codes.join(keyed, "id").select(
        "discount_key",
        id_digits(F.col("id")).alias("discount_id"),
        F.col("code").alias("discount_code"),
        F.col("title").alias("discount_title"),
        "discount_type",
        first_match(F.col("value_type"), DISCOUNT_VALUE_TYPES, default=F.col("value_type")).alias("value_type"),
        F.coalesce("value_amount", "value_percentage").alias("discount_value"),
        F.col("status").alias("discount_status"),
        F.col("starts_at").cast("date").alias("starts_at"),
        F.col("ends_at").cast("date").alias("ends_at"),
        "usage_limit",
        F.col("usage_count").alias("current_usage_count"),
        F.col("applies_once_per_customer").alias("is_one_per_customer"),
    )
    return with_member(
        align(built, "dim_discount"), "dim_discount", discount_key=0, discount_title="No Discount"
    ).withColumn("loaded_at", loaded_at)


def dim_location(locations: DataFrame, loaded_at: Column, number: Numbering = row_index) -> DataFrame:
    keyed = number(locations.select("id"), ["id"], "location_key")
    second_line = F.coalesce(F.concat(F.lit(", "), F.col("address2")), F.lit(""))
    built = locations.join(keyed, "id").select(
        "location_key",
        id_digits(F.col("id")).alias("location_id"),
        F.col("name").alias("location_name"),
        null_if_blank(F.concat(F.coalesce("address1", F.lit("")), second_line)).alias("address"),
        "city",
        "province",
        "country",
        "country_code",
        "is_active",
        F.col("fulfills_online_orders").alias("fulfills_online"),
    )
    return with_member(
        align(built, "dim_location"), "dim_location", location_key=-1, location_name="Unknown Location"
    ).withColumn("loaded_at", loaded_at)
