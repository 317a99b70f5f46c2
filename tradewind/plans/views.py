"""The fifteen metric views, as lazy frames over the warehouse tables.

Rates are doubles computed from exact sums. Each function reads only the columns it
names, so column pruning reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.scalars import count_if, ratio, zero
from tradewind.plans.facts import one_row_per_code

Tables = Mapping[str, DataFrame]


def average(c: str) -> Column:
    """Mean as exact sum over count."""
    return ratio(F.sum(c), F.count(c))


def calendar(dwh: Tables) -> DataFrame:
    return F.broadcast(dwh["dim_date"])  # bounded: one row per calendar day


def order_enriched(dwh: Tables) -> DataFrame:
    people = dwh["dim_customer"].select("customer_key", "membership_tier", "rfm_segment")
    hours = F.broadcast(dwh["dim_time"].select("time_key", F.col("hour_24").alias("order_hour"), "day_part"))
    return (
        dwh["fact_order"]
        .join(calendar(dwh), F.col("order_date_key") == F.col("date_key"))
        .join(hours, F.col("order_time_key") == F.col("time_key"), "left")
        .join(people, "customer_key", "left")
        .select(
            "order_key",
            F.col("full_date").alias("order_date"),
            "cal_year",
            "cal_quarter",
            "cal_month",
            "month_name",
            "day_name",
            "is_weekend",
            "order_hour",
            "day_part",
            "order_number",
            "order_created_at",
            F.col("source_name").alias("channel"),
            "financial_status",
            "fulfillment_status",
            "is_paid",
            "is_cancelled",
            "is_first_order",
            "is_repeat_customer",
            "has_discount",
            "customer_key",
            "customer_name",
            "customer_email",
            "customer_segment",
            "membership_tier",
            "rfm_segment",
            "shipping_city",
            "shipping_province",
            "shipping_country",
            "shipping_country_code",
            F.col("discount_1_code").alias("discount_code"),
            "subtotal_amount",
            "shipping_amount",
            "tax_amount",
            "discount_amount",
            "total_amount",
            "refund_amount",
            "net_amount",
            "line_item_count",
            "total_quantity",
            "unique_product_count",
            "currency_code",
            "landing_site",
            "referring_site",
        )
    )


def order_line_enriched(dwh: Tables) -> DataFrame:
    products = dwh["dim_product"].select("product_key", "product_id")
    return (
        dwh["fact_order_line_item"]
        .join(calendar(dwh), F.col("order_date_key") == F.col("date_key"))
        .join(products, "product_key", "left")
        .select(
            "line_item_key",
            "order_key",
            F.col("full_date").alias("order_date"),
            "cal_year",
            "cal_quarter",
            "cal_month",
            "month_name",
            "product_key",
            "product_id",
            "sku",
            "product_title",
            "variant_title",
            "product_type",
            "vendor",
            "quantity_ordered",
            "quantity_refunded",
            "unit_price",
            "unit_cost",
            "gross_amount",
            "discount_amount",
            "net_amount",
            (F.col("quantity_ordered") * F.col("unit_cost")).alias("line_cogs"),
            "gross_margin",
            "gross_margin_percent",
            "is_gift_card",
            "order_financial_status",
            "customer_email",
            "shipping_country",
        )
    )


def sales_daily(dwh: Tables) -> DataFrame:
    """Order and line totals meet on the day, so neither inflates the other."""
    headers = dwh["fact_order"].groupBy("order_date_key").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("net_amount").alias("net_revenue_after_refunds"),
        F.sum("tax_amount").alias("tax_collected"),
        F.sum("shipping_amount").alias("shipping_revenue"),
        F.sum("discount_amount").alias("discount_amount"),
        F.sum("refund_amount").alias("refund_amount"),
    )
    lines = dwh["fact_order_line_item"].groupBy("order_date_key").agg(
        F.sum("gross_amount").alias("gross_revenue"),
        F.sum("net_amount").alias("net_line_revenue"),
        F.sum("quantity_ordered").alias("units_sold"),
    )
    both = headers.join(lines, "order_date_key", "full")
    return both.join(calendar(dwh), F.col("order_date_key") == F.col("date_key")).select(
        F.col("full_date").alias("order_date"),
        "cal_year",
        "cal_quarter",
        "cal_month",
        "month_name",
        "day_name",
        "is_weekend",
        zero(F.col("orders")).alias("order_count"),
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("orders")).alias("average_order_value"),
        "gross_revenue",
        "net_line_revenue",
        "net_revenue_after_refunds",
        "units_sold",
        ratio(F.col("units_sold"), F.col("orders")).alias("units_per_transaction"),
        "tax_collected",
        "shipping_revenue",
        "discount_amount",
        "refund_amount",
    )


def channel_performance(dwh: Tables) -> DataFrame:
    return (
        dwh["fact_order"]
        .groupBy("source_name")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("total_amount").alias("total_revenue"),
            ratio(F.sum("total_amount"), F.count(F.lit(1))).alias("average_order_value"),
            F.sum("total_quantity").alias("units_sold"),
        )
        .withColumn("channel", F.coalesce("source_name", F.lit("(unknown)")))
        .drop("source_name")
    )


def customer_metrics(dwh: Tables) -> DataFrame:
    return (
        dwh["dim_customer"]
        .filter("customer_key > 0")
        .select(
            "customer_key",
            "customer_id",
            "full_name",
            "email",
            "customer_segment",
            "membership_tier",
            F.col("lifetime_revenue").alias("customer_lifetime_value"),
            "lifetime_order_count",
            "average_order_value",
            "first_order_date",
            "last_order_date",
            "days_since_last_order",
            "rfm_recency_score",
            "rfm_frequency_score",
            "rfm_monetary_score",
            "rfm_combined_score",
            "rfm_segment",
        )
    )


def customer_summary(dwh: Tables) -> DataFrame:
    """One pass over customers and one over orders, joined as a scalar."""
    revenue = dwh["fact_order"].agg(
        F.struct(
            F.sum(F.when(F.col("is_first_order"), F.col("total_amount"))).alias("first"),
            F.sum(F.when(~F.col("is_first_order"), F.col("total_amount"))).alias("later"),
        )
    )
    people = dwh["dim_customer"].filter("customer_key > 0").agg(
        F.count(F.lit(1)).alias("total_customers"),
        count_if(F.col("lifetime_order_count") >= 2).alias("repeat_customers"),
        average("lifetime_revenue").alias("avg_lifetime_value"),
    )
    with_revenue = people.withColumn("r", revenue.scalar())
    return with_revenue.select(
        "total_customers",
        "repeat_customers",
        ratio(F.col("repeat_customers"), F.col("total_customers"), 100).alias("repeat_purchase_rate"),
        "avg_lifetime_value",
        F.col("r.first").alias("new_customer_revenue"),
        F.col("r.later").alias("returning_customer_revenue"),
    )


def product_performance(dwh: Tables) -> DataFrame:
    """Lines are summed per product before the product attributes join."""
    sums = (
        dwh["fact_order_line_item"]
        .filter("product_key > 0")
        .groupBy("product_key")
        .agg(
            F.sum("quantity_ordered").alias("units_sold"),
            F.sum("net_amount").alias("product_revenue"),
            F.sum("gross_amount").alias("gross_revenue"),
            F.sum(F.col("quantity_ordered") * F.col("unit_cost")).alias("cogs"),
            F.sum("gross_margin").alias("gross_margin"),
        )
    )
    products = dwh["dim_product"].select("product_key", "product_id", "product_title", "product_type", "vendor", "sku")
    return sums.join(products, "product_key").select(
        "product_key",
        "product_id",
        "product_title",
        "product_type",
        "vendor",
        "sku",
        "units_sold",
        "product_revenue",
        "gross_revenue",
        ratio(F.col("product_revenue"), F.col("units_sold")).alias("average_selling_price"),
        "cogs",
        "gross_margin",
        ratio(F.col("gross_margin"), F.col("product_revenue"), 100).alias("gross_margin_percent"),
    )


def discount_summary(dwh: Tables) -> DataFrame:
    totals = dwh["fact_order"].agg(
        F.count(F.lit(1)).alias("total_orders"),
        count_if(F.col("has_discount")).alias("discounted_orders"),
        F.sum("discount_amount").alias("total_discount_amount"),
    )
    return totals.select(
        "total_orders",
        "discounted_orders",
        ratio(F.col("discounted_orders"), F.col("total_orders"), 100).alias("discount_usage_rate"),
        "total_discount_amount",
        ratio(F.col("total_discount_amount"), F.col("discounted_orders")).alias("avg_discount_per_order"),
    )


def discount_code_performance(dwh: Tables) -> DataFrame:
    used = (
        dwh["fact_order"]
        .filter("discount_1_code is not null")
        .groupBy(F.col("discount_1_code").alias("discount_code"))
        .agg(
            F.count(F.lit(1)).alias("orders_using_code"),
            F.sum("total_amount").alias("revenue_with_code"),
            F.sum("discount_amount").alias("discount_given"),
        )
    )
    codes = one_row_per_code(dwh["dim_discount"]).select(
        "discount_code", F.col("current_usage_count").alias("usage_count"), "usage_limit"
    )
    return used.join(codes, "discount_code", "left").withColumn(
        "redemption_rate", ratio(F.col("usage_count"), F.col("usage_limit"), 100)
    )


def fulfillment_performance(dwh: Tables) -> DataFrame:
    total = F.count(F.lit(1))
    return (
        dwh["fact_fulfillment"]
        .groupBy("location_name")
        .agg(
            total.alias("fulfillment_count"),
            average("fulfillment_time_hours").alias("avg_fulfillment_hours"),
            average("fulfillment_time_days").alias("avg_fulfillment_days"),
            ratio(count_if(F.col("is_same_day")), total, 100).alias("same_day_rate"),
            ratio(count_if(F.col("is_within_48h")), total, 100).alias("on_time_rate"),
            ratio(count_if(F.col("is_late")), total, 100).alias("late_rate"),
        )
        .withColumn("location_name", F.coalesce("location_name", F.lit("(unknown)")))
    )


def refund_analysis(dwh: Tables) -> DataFrame:
    orders = dwh["fact_order"].agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("revenue"))
    )
    refunds = dwh["fact_refund"].agg(
        F.count(F.lit(1)).alias("refund_count"),
        F.sum("refund_amount").alias("total_refund_amount"),
        F.sum("total_items_refunded").alias("items_refunded"),
        F.sum("items_restocked").alias("restocked"),
        F.countDistinct("order_key").alias("refunded_orders"),
    )
    return refunds.withColumn("o", orders.scalar()).select(
        "refund_count",
        "total_refund_amount",
        "items_refunded",
        ratio(F.col("restocked"), F.col("items_refunded"), 100).alias("restock_rate"),
        ratio(F.col("refunded_orders"), F.col("o.n"), 100).alias("refund_rate_orders"),
        ratio(F.col("total_refund_amount"), F.col("o.revenue"), 100).alias("refund_percent_of_revenue"),
    )


def latest_snapshot(dwh: Tables) -> DataFrame:
    levels = dwh["fact_inventory_snapshot"]
    return levels.filter(F.col("snapshot_date") == levels.agg(F.max("snapshot_date")).scalar())


def inventory_status(dwh: Tables) -> DataFrame:
    return latest_snapshot(dwh).select(
        "product_key",
        "sku",
        "product_title",
        "variant_title",
        "product_type",
        "vendor",
        "location_name",
        "snapshot_date",
        "available_quantity",
        "on_hand_quantity",
        "committed_quantity",
        "inventory_cost_value",
        "inventory_retail_value",
        "is_out_of_stock",
        "is_low_stock",
        "is_overstocked",
    )


def inventory_summary(dwh: Tables) -> DataFrame:
    totals = latest_snapshot(dwh).agg(
        F.count(F.lit(1)).alias("sku_location_count"),
        count_if(F.col("is_out_of_stock")).alias("out_of_stock_count"),
        F.sum("inventory_cost_value").alias("total_inventory_cost_value"),
        F.sum("inventory_retail_value").alias("total_inventory_retail_value"),
    )
    return totals.withColumn("stock_out_rate", ratio(F.col("out_of_stock_count"), F.col("sku_location_count"), 100))


def abandoned_checkout_summary(checkouts: DataFrame) -> DataFrame:
    totals = checkouts.agg(
        count_if(F.col("completed_at").isNull()).alias("abandoned_count"),
        F.count("completed_at").alias("completed_count"),
    )
    return totals.withColumn(
        "abandonment_rate",
        ratio(F.col("abandoned_count"), F.col("abandoned_count") + F.col("completed_count"), 100),
    )


def product_days(dwh: Tables, lines: DataFrame | None = None) -> DataFrame:
    """The rows of ``agg_product_day``: revenue, units and orders of each product on each day of the calendar that ``lines`` (all) have."""
    products = dwh["dim_product"].select("product_key", "product_id", "product_title")
    lines = dwh["fact_order_line_item"] if lines is None else lines
    # Lines meet once, by day and product: both sums below keep that partitioning. The calendar comes last.
    placed = (
        lines.select("order_date_key", "product_key", "order_key", "net_amount", "quantity_ordered")
        .join(products, "product_key")
        .repartition("order_date_key", "product_id", "product_title")
    )
    day = ["order_date_key", "product_id", "product_title"]
    per_order = placed.groupBy(*day, "order_key").agg(F.sum("net_amount").alias("revenue"), F.sum("quantity_ordered").alias("units"))
    daily = per_order.groupBy(*day).agg(
        zero(F.sum("revenue")).alias("revenue"), zero(F.sum("units")).alias("units"), F.count(F.lit(1)).alias("orders")
    )
    days = calendar(dwh).select("date_key", F.col("full_date").alias("order_date"))
    return daily.join(days, F.col("order_date_key") == F.col("date_key")).drop("date_key")


def revenue_by_product_by_day(dwh: Tables, since: date | None = None) -> DataFrame:
    """Revenue per day and product, the Unknown product included; refunds are not netted.

    A warehouse keeps the table of product days; over other tables it is made here. ``since`` limits the days by their key,
    a filter that reaches the Parquet scan; a filter on the calendar's day alone would not.
    """
    kept = "agg_product_day" in set(dwh)
    recent = None if since is None else F.col("order_date_key") >= int(since.strftime("%Y%m%d"))
    if kept:
        daily = dwh["agg_product_day"] if recent is None else dwh["agg_product_day"].filter(recent)
    else:
        daily = product_days(dwh, None if recent is None else dwh["fact_order_line_item"].filter(recent))
    return daily.select("order_date", "product_id", "product_title", "revenue", "units", "orders")


# fixed values: the names queries use
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "v_order_enriched": order_enriched,
    "v_order_line_enriched": order_line_enriched,
    "v_sales_daily": sales_daily,
    "v_channel_performance": channel_performance,
    "v_customer_metrics": customer_metrics,
    "v_customer_summary": customer_summary,
    "v_product_performance": product_performance,
    "v_discount_summary": discount_summary,
    "v_discount_code_performance": discount_code_performance,
    "v_fulfillment_performance": fulfillment_performance,
    "v_refund_analysis": refund_analysis,
    "v_inventory_status": inventory_status,
    "v_inventory_summary": inventory_summary,
    "v_revenue_by_product_by_day": revenue_by_product_by_day,
}


def register_views(spark: SparkSession, dwh: Tables, stg: Tables) -> list[str]:
    """Create or replace every view, and the tables behind them, for ``spark.sql``."""
    for table in dwh:
        dwh[table].createOrReplaceTempView(table)
    for name, view in VIEWS.items():
        view(dwh).createOrReplaceTempView(name)
    name = "v_abandoned_checkout_summary"
    abandoned_checkout_summary(stg["stg_abandoned_checkouts"]).createOrReplaceTempView(name)
    return [*VIEWS, name]
