"""Catalogue metrics beyond the views: growth, retention, cohorts, stock, returns."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.functions.scalars import count_if, id_digits, month_key, ratio, zero
from tradewind.plans import views

Tables = Mapping[str, DataFrame]


def _months_between(later: Column, earlier: Column) -> Column:
    """Whole months between two yyyymm keys."""
    return (F.floor(later / 100) - F.floor(earlier / 100)) * 12 + later % 100 - earlier % 100


def _order_month() -> Column:
    return F.floor(F.col("order_date_key") / 100)


def sales_growth(dwh: Tables) -> DataFrame:
    """Revenue of each calendar month, from the first to the last with orders, against the month before.

    A month without orders counts as 0. The window runs over one row per month, a frame bounded by the calendar.
    """
    monthly = dwh["fact_order"].groupBy(_order_month().alias("sold_month")).agg(F.sum("total_amount").alias("revenue"))
    ends = monthly.agg(F.struct(F.min("sold_month").alias("first"), F.max("sold_month").alias("last"))).scalar()
    months = dwh["dim_date"].select(F.floor(F.col("date_key") / 100).alias("month")).distinct().withColumn("ends", ends)
    months = months.filter(F.col("month").between(F.col("ends.first"), F.col("ends.last")))
    filled = months.join(monthly, F.col("month") == F.col("sold_month"), "left").select("month", zero(F.col("revenue")).alias("revenue"))
    prior = F.lag("revenue").over(W.orderBy("month"))
    return filled.withColumn("prior_revenue", prior).withColumn(
        "growth_rate", ratio(F.col("revenue") - F.col("prior_revenue"), F.col("prior_revenue"), 100)
    )


def customer_months(dwh: Tables) -> DataFrame:
    """One row per customer and month with an order, with the month's revenue."""
    return (
        dwh["fact_order"]
        .filter("customer_key > 0")
        .groupBy("customer_key", _order_month().alias("month"))
        .agg(F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )


def retention(dwh: Tables) -> DataFrame:
    """Retention and churn of each month.

    Start: customers of the month before. End: customers of the month. New: customers
    whose first order ever falls in the month. Lost: customers of the month before
    without an order in this one. A customer-month is counted where it stands and once
    more as the start of the following month, so no self-join is needed.
    """
    months = customer_months(dwh).select("customer_key", "month")
    first = months.groupBy("customer_key").agg(F.min("month").alias("first_month"))
    active = months.join(first, "customer_key")
    following = F.when(F.col("month") % 100 == 12, F.col("month") + 89).otherwise(F.col("month") + 1)
    roles = active.select(
        "customer_key",
        "first_month",
        F.explode(
            F.array(
                F.struct(F.col("month").alias("month"), F.lit(1).alias("here"), F.lit(0).alias("before")),
                F.struct(following.alias("month"), F.lit(0).alias("here"), F.lit(1).alias("before")),
            )
        ).alias("r"),
    ).select("customer_key", "first_month", "r.*")
    state = roles.groupBy("customer_key", "month", "first_month").agg(
        F.max("here").alias("here"), F.max("before").alias("before")
    )
    totals = state.groupBy("month").agg(
        F.sum("before").alias("customers_at_start"),
        F.sum("here").alias("customers_at_end"),
        count_if((F.col("here") == 1) & (F.col("month") == F.col("first_month"))).alias("new_customers"),
        count_if((F.col("before") == 1) & (F.col("here") == 0)).alias("lost_customers"),
    )
    kept = F.col("customers_at_end") - F.col("new_customers")
    return (
        totals.filter("customers_at_end > 0")
        .withColumn("retention_rate", ratio(kept, F.col("customers_at_start"), 100))
        .withColumn("churn_rate", ratio(F.col("lost_customers"), F.col("customers_at_start"), 100))
    )


def cohorts(dwh: Tables) -> DataFrame:
    """Customers, revenue and revenue per cohort member by first-order month and age."""
    months = customer_months(dwh)
    first = months.groupBy("customer_key").agg(F.min("month").alias("cohort"))
    aged = months.join(first, "customer_key").withColumn("age", _months_between(F.col("month"), F.col("cohort")))
    sizes = first.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    cells = aged.groupBy("cohort", "age").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("revenue").alias("revenue")
    )
    return cells.join(sizes, "cohort").select(
        "cohort",
        "age",
        "cohort_size",
        "active_customers",
        "revenue",
        ratio(F.col("active_customers"), F.col("cohort_size"), 100).alias("retention_rate"),
        ratio(F.col("revenue"), F.col("cohort_size")).alias("revenue_per_member"),
    )


def purchase_rhythm(dwh: Tables) -> DataFrame:
    """Orders per customer and the mean gap in days between a customer's orders.

    The gaps of one customer add up to last minus first day, so their mean needs no
    window over the customer's orders.
    """
    day = F.col("order_created_at").cast("date")
    people = (
        dwh["fact_order"]
        .filter("customer_key > 0")
        .groupBy("customer_key")
        .agg(F.count(F.lit(1)).alias("orders"), F.datediff(F.max(day), F.min(day)).alias("span"))
    )
    return people.agg(
        F.sum("orders").alias("orders"),
        F.count(F.lit(1)).alias("customers"),
        ratio(F.sum("orders"), F.count(F.lit(1))).alias("purchase_frequency"),
        ratio(F.sum("span"), F.sum(F.col("orders") - 1)).alias("avg_days_between_orders"),
    )


def customer_gaps(dwh: Tables) -> DataFrame:
    """Mean days between the orders of each customer with at least two."""
    day = F.col("order_created_at").cast("date")
    people = (
        dwh["fact_order"]
        .filter("customer_key > 0")
        .groupBy("customer_key")
        .agg(F.count(F.lit(1)).alias("orders"), F.datediff(F.max(day), F.min(day)).alias("span"))
        .filter("orders > 1")
    )
    return people.select("customer_key", "orders", ratio(F.col("span"), F.col("orders") - 1).alias("avg_days_between_orders"))


# --- products and stock -------------------------------------------------------------
def fact_refund_line(stg: Tables, dwh: Tables) -> DataFrame:
    """Refunded lines with the product they belong to."""
    returned = stg["stg_refund_line_items"].select(
        id_digits(F.col("line_item_id")).alias("line_item_id"),
        id_digits(F.col("refund_id")).alias("refund_id"),
        F.col("quantity").alias("refunded_quantity"),
        "restock_type",
        "subtotal_amount",
    )
    lines = dwh["fact_order_line_item"].select("line_item_id", "line_item_key", "order_key", "product_key", "order_date_key")
    return returned.join(lines, "line_item_id")


def product_return_rate(stg: Tables, dwh: Tables) -> DataFrame:
    returned = fact_refund_line(stg, dwh).groupBy("product_key").agg(F.sum("refunded_quantity").alias("units_refunded"))
    sold = (
        dwh["fact_order_line_item"]
        .filter("product_key > 0")
        .groupBy("product_key")
        .agg(F.sum("quantity_ordered").alias("units_sold"))
    )
    return sold.join(returned, "product_key", "left").select(
        "product_key",
        "units_sold",
        zero(F.col("units_refunded")).alias("units_refunded"),
        ratio(zero(F.col("units_refunded")), F.col("units_sold"), 100).alias("return_rate"),
    )


def sell_through(dwh: Tables, start: date, end: date) -> DataFrame:
    """Units sold in a period against the stock on the first snapshot day inside it."""
    within = F.col("snapshot_date").between(F.lit(start), F.lit(end))
    stock = dwh["fact_inventory_snapshot"].filter("product_key > 0").filter(within)
    opening = stock.filter(F.col("snapshot_date") == stock.agg(F.min("snapshot_date")).scalar())
    held = opening.groupBy("product_key").agg(F.sum(zero(F.col("on_hand_quantity"))).alias("opening_units"))
    keys = [int(day.strftime("%Y%m%d")) for day in (start, end)]
    sold = (
        dwh["fact_order_line_item"]
        .filter(F.col("order_date_key").between(*keys))
        .groupBy("product_key")
        .agg(F.sum("quantity_ordered").alias("units_sold"))
    )
    return held.join(sold, "product_key", "left").select(
        "product_key",
        "opening_units",
        zero(F.col("units_sold")).alias("units_sold"),
        ratio(zero(F.col("units_sold")), F.col("opening_units"), 100).alias("sell_through_rate"),
    )


def inventory_turnover(dwh: Tables, year: int) -> DataFrame:
    """Cost of goods sold in a year over the mean stock value of the snapshot days."""
    value = (
        dwh["fact_inventory_snapshot"]
        .groupBy("snapshot_date")
        .agg(F.sum("inventory_cost_value").alias("value"))
        .agg(F.struct(F.sum("value").alias("total"), F.count(F.lit(1)).alias("days")))
    )
    cogs = dwh["fact_order_line_item"].filter(F.col("order_date_key").between(year * 10000, year * 10000 + 9999)).agg(
        F.sum(F.col("quantity_ordered") * F.col("unit_cost")).alias("cogs")
    )
    mean = ratio(F.col("v.total"), F.col("v.days"))
    return cogs.withColumn("v", value.scalar()).select(
        "cogs",
        mean.alias("average_inventory_value"),
        ratio(F.col("cogs"), mean).alias("inventory_turnover"),
        (mean / F.nullif(F.col("cogs").cast("double"), F.lit(0.0)) * 365).alias("days_of_inventory"),
    )


def revenue_contribution(dwh: Tables) -> DataFrame:
    """Share of each product in all line revenue; the total is a scalar, not a window."""
    lines = dwh["fact_order_line_item"]
    total = lines.agg(F.sum("net_amount")).scalar()
    return (
        lines.groupBy("product_key")
        .agg(F.sum("net_amount").alias("revenue"))
        .withColumn("contribution", ratio(F.col("revenue"), total, 100))
    )


def stock_out_days(dwh: Tables) -> DataFrame:
    return (
        dwh["fact_inventory_snapshot"]
        .groupBy("inventory_item_id", "location_id")
        .agg(
            F.count(F.lit(1)).alias("days"),
            count_if(F.col("is_out_of_stock")).alias("days_out"),
        )
        .withColumn("stock_out_share", ratio(F.col("days_out"), F.col("days"), 100))
    )


def dead_stock(dwh: Tables, since: date) -> DataFrame:
    """Value on the latest day of products without a sale since a day."""
    recent = (
        dwh["fact_order_line_item"]
        .filter(F.col("order_date_key") >= int(since.strftime("%Y%m%d")))
        .select("product_key")
        .distinct()
        .withColumn("sold", F.lit(True))
    )
    held = views.latest_snapshot(dwh).groupBy("product_key").agg(F.sum("inventory_cost_value").alias("value"))
    # An unknown product never counts as sold, so its stock is not hidden by other lines.
    joined = held.join(recent.filter("product_key > 0"), "product_key", "left")
    return joined.agg(
        F.sum(F.when(F.col("sold").isNull(), F.col("value")).otherwise(0)).alias("dead_value"),
        F.sum("value").alias("total_value"),
    ).withColumn("dead_share", ratio(F.col("dead_value"), F.col("total_value"), 100))


def sales_velocity(dwh: Tables) -> DataFrame:
    """Units per day with a sale, by product. Lines collapse per product and day first."""
    daily = dwh["fact_order_line_item"].groupBy("product_key", "order_date_key").agg(
        F.sum("quantity_ordered").alias("units")
    )
    return (
        daily.groupBy("product_key")
        .agg(F.sum("units").alias("units_sold"), F.count(F.lit(1)).alias("days_sold"))
        .withColumn("units_per_day", ratio(F.col("units_sold"), F.col("days_sold")))
    )


# --- orders and money ------------------------------------------------------------------
def discount_penetration(dwh: Tables) -> DataFrame:
    discounted = F.sum(F.when(F.col("has_discount"), F.col("total_amount")).otherwise(0))
    return dwh["fact_order"].agg(
        discounted.alias("discounted_revenue"),
        F.sum("total_amount").alias("total_revenue"),
        ratio(discounted, F.sum("total_amount"), 100).alias("discount_penetration"),
    )


def order_return_rates(dwh: Tables) -> DataFrame:
    """Orders with any refund, and orders with returned goods, against all orders."""
    per_order = dwh["fact_refund"].groupBy("order_key").agg(F.max(F.col("total_items_refunded") > 0).alias("goods"))
    counts = per_order.agg(F.struct(F.count(F.lit(1)).alias("refunded"), count_if(F.col("goods")).alias("returned")))
    return (
        dwh["fact_order"]
        .agg(F.count(F.lit(1)).alias("orders"))
        .withColumn("r", counts.scalar())
        .select(
            "orders",
            F.col("r.refunded").alias("refunded_orders"),
            F.col("r.returned").alias("returned_orders"),
            ratio(F.col("r.refunded"), F.col("orders"), 100).alias("refund_rate"),
            ratio(F.col("r.returned"), F.col("orders"), 100).alias("return_rate"),
        )
    )


def tax_by_region(dwh: Tables) -> DataFrame:
    return dwh["fact_order"].groupBy("shipping_country").agg(
        F.sum("tax_amount").alias("tax_collected"), F.count(F.lit(1)).alias("orders")
    )


def revenue_by_site(orders: DataFrame, column: str, part: str = "HOST") -> DataFrame:
    """Revenue by the path of landing addresses or the host of referring ones.

    A path without a host stands for itself; no address, and an address without that part, count as direct.
    """
    site = F.try_parse_url(F.col(column), F.lit(part))
    if part == "PATH":
        site = F.when(F.col(column).startswith("/"), F.regexp_extract(column, "^[^?#]*", 0)).otherwise(site)
    return orders.groupBy(F.coalesce(F.nullif(site, F.lit("")), F.lit("(direct)")).alias("site")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue")
    )


def recovered_checkouts(checkouts: DataFrame) -> DataFrame:
    totals = checkouts.agg(F.count("completed_at").alias("recovered"), count_if(F.col("completed_at").isNull()).alias("abandoned"))
    return totals.withColumn("recovery_rate", ratio(F.col("recovered"), F.col("abandoned"), 100))


def profit(stg: Tables, dwh: Tables) -> DataFrame:
    """Gross and contribution profit per product and month of the order.

    Cost of goods skips lines without a cost, as the product view does. Contribution also takes off what was
    refunded for the lines.
    """
    refunded = stg["stg_refund_line_items"].groupBy(id_digits(F.col("line_item_id")).alias("refunded_line")).agg(
        F.sum("subtotal_amount").alias("refunded")
    )
    lines = dwh["fact_order_line_item"].select(
        "line_item_id", "product_key", _order_month().alias("month"), "net_amount", (F.col("quantity_ordered") * F.col("unit_cost")).alias("cost")
    )
    totals = (
        lines.join(refunded, F.col("line_item_id") == F.col("refunded_line"), "left")
        .groupBy("product_key", "month")
        .agg(F.sum("net_amount").alias("revenue"), F.sum("cost").alias("cogs"), zero(F.sum("refunded")).alias("refunds"))
    )
    gross = F.col("revenue") - zero(F.col("cogs"))
    left_over = gross - F.col("refunds")
    return totals.select(
        "product_key",
        "month",
        "revenue",
        "cogs",
        "refunds",
        gross.alias("gross_profit"),
        ratio(gross, F.col("revenue"), 100).alias("gross_margin_percent"),
        left_over.alias("contribution"),
        ratio(left_over, F.col("revenue"), 100).alias("contribution_margin_percent"),
    )


def rfm_segments(dwh: Tables) -> DataFrame:
    return (
        dwh["dim_customer"]
        .filter("customer_key > 0")
        .groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("lifetime_revenue").alias("total_revenue"),
            views.average("average_order_value").alias("avg_aov"),
            views.average("days_since_last_order").alias("avg_recency"),
        )
    )
