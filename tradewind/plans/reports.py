"""Reports whose shape is not a plain filter over the warehouse or voucher layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import count_if, null_if_blank, ratio, zero

Tables = Mapping[str, DataFrame]


def month_range(last: date, count: int) -> list[int]:
    """``count`` yyyymm keys ending with the month of ``last``."""
    index = last.year * 12 + last.month - 1
    return [(i // 12) * 100 + i % 12 + 1 for i in range(index - count + 1, index + 1)]


def compare_orders(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Orders that one of two systems misses or that differ in value."""
    both = left.select(key, F.col(value).alias("left_value")).join(
        right.select(key, F.col(value).alias("right_value")), key, "full"
    )
    state = (
        F.when(F.col("left_value").isNull(), "missing_left")
        .when(F.col("right_value").isNull(), "missing_right")
        .when(F.col("left_value") != F.col("right_value"), "different")
    )
    return both.withColumn("state", state).filter(F.col("state").isNotNull())


def presence(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present in only one of two lists."""
    # Distinct first on both sides: a key that repeats often is reduced before the shuffle.
    left, right = left.select(key).distinct(), right.select(key).distinct()
    only_left = left.join(right, key, "left_anti").withColumn("present_in", F.lit("left"))
    only_right = right.join(left, key, "left_anti").withColumn("present_in", F.lit("right"))
    return only_left.unionByName(only_right)


def missing_contact(orders: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a blank in any of the contact columns."""
    blank = F.lit(False)
    for name in columns:
        blank = blank | null_if_blank(F.col(name)).isNull()
    return orders.filter(blank)


def order_volume(dwh: Tables, unit: str = "day") -> DataFrame:
    period = F.date_trunc(unit, F.col("order_created_at")).cast("date")
    return dwh["fact_order"].groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("orders"))


def revenue_by_tender(split: DataFrame, unit: str = "day") -> DataFrame:
    """Order money by gift card, discount and cash, with the cash share."""
    key = F.col("order_date_key")
    period = key if unit == "day" else F.floor(key / 100)
    return (
        split.groupBy(period.alias("period"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("total_amount").alias("total_revenue"),
            F.sum("gc_amount").alias("gift_card_spend"),
            F.sum("discount_amount").alias("discount_spend"),
            F.sum("cash_amount").alias("cash_spend"),
        )
        .withColumn("cash_percent", ratio(F.col("cash_spend"), F.col("total_revenue"), 100))
    )


def redemption_trend(lifecycle: DataFrame, last: date, months: int = 6) -> DataFrame:
    """Redeemed vouchers per channel, one column per month."""
    keys = month_range(last, months)
    month = F.floor(F.col("redemption_date_key") / 100).cast("int")
    counts = (
        lifecycle.filter(F.col("redemption_date_key").between(keys[0] * 100, keys[-1] * 100 + 99))
        .withColumn("month", month)
        .groupBy("channel_name")
        .pivot("month", keys)
        .agg(F.count(F.lit(1)))
    )
    return counts.select("channel_name", *[zero(F.col(str(k))).alias(f"m{k}") for k in keys])


def multiple_redemptions(lifecycle: DataFrame) -> DataFrame:
    """Redeemed vouchers on orders that used both a card and a discount, per channel."""
    return (
        lifecycle.filter("is_redeemed and is_dual_redemption")
        .groupBy("channel_name", "voucher_type")
        .agg(
            F.count(F.lit(1)).alias("redeemed_vouchers"),
            F.sum("face_value").alias("face_value"),
            F.sum("redemption_order_total").alias("total_amount"),
        )
    )


def product_months(dwh: Tables, last: date, months: int = 6) -> DataFrame:
    """Units of every catalogue product in each of the last months, zero sellers included."""
    keys = month_range(last, months)
    recent = dwh["fact_order_line_item"].filter(F.col("order_date_key").between(keys[0] * 100, keys[-1] * 100 + 99))
    sold = (
        recent.groupBy("product_key", F.floor(F.col("order_date_key") / 100).cast("int").alias("month"))
        .agg(F.sum("quantity_ordered").alias("units"))
        .groupBy("product_key")
        .agg(
            *[F.sum(F.when(F.col("month") == k, F.col("units")).otherwise(0)).alias(f"m{k}") for k in keys],
            F.sum("units").alias("total_units"),
        )
    )
    products = dwh["dim_product"].filter("product_key > 0").select("product_key", "full_title")
    return products.join(sold, "product_key", "left").na.fill(0)


def popular_products(dwh: Tables, last: date, months: int = 6) -> DataFrame:
    """All products, best sellers of the last month first."""
    current = f"m{month_range(last, months)[-1]}"
    return product_months(dwh, last, months).orderBy(F.desc(current), F.desc("total_units"), "product_key")


def least_products(dwh: Tables, last: date, months: int = 6) -> DataFrame:
    """All products, worst sellers of the last month first."""
    current = f"m{month_range(last, months)[-1]}"
    return product_months(dwh, last, months).orderBy(current, "total_units", "product_key")


def new_products(dwh: Tables) -> DataFrame:
    return (
        dwh["dim_product"]
        .filter("product_key > 0")
        .groupBy("product_created_date", "product_status")
        .agg(F.count(F.lit(1)).alias("variants"), count_if(F.col("sku").isNotNull()).alias("skus"))
    )


def brand_channel_sales(dwh: Tables, vendor: str, channel: str) -> DataFrame:
    """Lines of one brand on orders that redeemed a voucher of one channel.

    An order counts once, however many of the channel's vouchers it used.
    """
    orders = (
        dwh["dim_voucher"]
        .filter((F.col("channel_name") == channel) & F.col("redemption_order_id").isNotNull())
        .select(F.col("redemption_order_id").alias("order_id"))
    )
    units, cost = F.col("quantity_ordered"), F.col("unit_cost")
    return (
        dwh["fact_order_line_item"]
        .filter(F.col("vendor") == vendor)
        .join(orders, "order_id", "left_semi")
        .groupBy("sku", "product_title")
        .agg(
            F.sum(units).alias("quantity"),
            F.sum(units * cost).alias("total_cost"),
            F.sum("net_amount").alias("total_price"),
        )
    )


def membership_orders(dwh: Tables, tiers: Sequence[str]) -> DataFrame:
    """Orders per month, one column per membership tier."""
    people = dwh["dim_customer"].filter("membership_tier is not null").select("customer_key", "membership_tier")
    counts = (
        dwh["fact_order"]
        .join(people, "customer_key")
        .groupBy(F.floor(F.col("order_date_key") / 100).alias("month"))
        .pivot("membership_tier", list(tiers))
        .agg(F.count(F.lit(1)))
    )
    return counts.select(
        "month", *[zero(F.col(f"`{tier}`")).alias(tier.lower().replace(" ", "_")) for tier in tiers]
    )


def incomplete_redemptions(dim_voucher: DataFrame) -> DataFrame:
    """Redeemed vouchers that lack an order, a campaign or a known channel, or were never sent."""
    missing = (
        F.col("redemption_order_id").isNull()
        | F.col("redemption_date").isNull()
        | F.col("campaign_name").isNull()
        | (F.col("channel_key") == 0)
        | ~F.col("is_distributed")
    )
    return dim_voucher.filter((F.col("voucher_key") > 0) & F.col("is_redeemed") & missing).select(
        "voucher_code", "voucher_type", "redemption_date", "redemption_order_id", "campaign_name", "channel_name"
    )
