"""Verification and reconciliation queries over staging and warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import count_if
from tradewind.operators.relational import labelled_counts
from tradewind.plans import views
from tradewind.sources import schemas

Tables = Mapping[str, DataFrame]

# fixed values: key of the fixed member of each dimension
MEMBERS = {
    "unknown_product": ("dim_product", "product_key", -1),
    "unknown_customer": ("dim_customer", "customer_key", -1),
    "unknown_geography": ("dim_geography", "geography_key", -1),
    "unknown_location": ("dim_location", "location_key", -1),
    "no_discount": ("dim_discount", "discount_key", 0),
}


def _one_row(**parts: DataFrame) -> DataFrame:
    """One-row aggregates side by side, each a scalar subquery."""
    spark = next(iter(parts.values())).sparkSession
    return spark.range(1).select([part.scalar().alias(name) for name, part in parts.items()])


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)))


def warehouse_counts(dwh: Tables) -> DataFrame:
    return labelled_counts({table: dwh[table] for table in schemas.WAREHOUSE}, "obj")


def generated_dimensions(dwh: Tables) -> DataFrame:
    days = dwh["dim_date"].agg(
        F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"), F.count(F.lit(1)).alias("days")
    )
    hours = dwh["dim_time"].agg(
        F.struct(
            F.count(F.lit(1)).alias("time_rows"), F.min("time_key").alias("min_key"), F.max("time_key").alias("max_key")
        )
    )
    known = dwh["dim_date"].select(F.col("date_key").alias("order_date_key"))
    outside = dwh["fact_order"].select("order_date_key").join(F.broadcast(known), "order_date_key", "left_anti").agg(F.count(F.lit(1)))
    return days.withColumn("t", hours.scalar()).select("min_date", "max_date", "days", "t.*", outside.scalar().alias("orders_outside"))


def members(dwh: Tables) -> DataFrame:
    """How often each fixed member occurs; every count must be 1."""
    return _one_row(
        **{name: _count(dwh[table].filter(F.col(key) == value)) for name, (table, key, value) in MEMBERS.items()}
    )


def orders_reconcile(stg: Tables, dwh: Tables) -> DataFrame:
    """Rows and money of the order fact against staging; both must be equal."""
    return _one_row(
        fact_order_rows=_count(dwh["fact_order"]),
        stg_order_rows=_count(stg["stg_orders"]),
        fact_total=dwh["fact_order"].agg(F.sum("total_amount")),
        stg_total=stg["stg_orders"].agg(F.sum("total_price")),
    )


def lines_reconcile(stg: Tables, dwh: Tables) -> DataFrame:
    """Lines of a missing order are dropped, so the fact may hold fewer."""
    return _one_row(
        fact_line_rows=_count(dwh["fact_order_line_item"]),
        stg_line_rows=_count(stg["stg_order_line_items"]),
        fact_net=dwh["fact_order_line_item"].agg(F.sum("net_amount")),
        stg_net=stg["stg_order_line_items"].agg(F.sum("discounted_total")),
    )


def children_reconcile(stg: Tables, dwh: Tables) -> DataFrame:
    return _one_row(
        fact_fulfillment_rows=_count(dwh["fact_fulfillment"]),
        stg_fulfillment_rows=_count(stg["stg_fulfillments"]),
        fact_refund_rows=_count(dwh["fact_refund"]),
        stg_refund_rows=_count(stg["stg_refunds"]),
        fact_inventory_rows=_count(dwh["fact_inventory_snapshot"]),
        stg_inventory_rows=_count(stg["stg_inventory_levels"]),
    )


def orphan_keys(dwh: Tables) -> DataFrame:
    """Facts without a calendar day or with a NULL key; every count must be 0."""
    days = F.broadcast(dwh["dim_date"].select(F.col("date_key").alias("order_date_key")))
    orders = dwh["fact_order"].agg(
        F.struct(
            count_if(F.col("customer_key").isNull()).alias("order_null_customer_key"),
            count_if(F.col("shipping_geography_key").isNull()).alias("order_null_ship_geo_key"),
        )
    )
    lines = dwh["fact_order_line_item"].agg(
        F.struct(
            count_if(F.col("order_key").isNull()).alias("line_null_order_key"),
            count_if(F.col("product_key").isNull()).alias("line_null_product_key"),
        )
    )
    return _one_row(
        order_dates_missing_in_dimdate=_count(dwh["fact_order"].join(days, "order_date_key", "left_anti")),
        line_dates_missing_in_dimdate=_count(dwh["fact_order_line_item"].join(days, "order_date_key", "left_anti")),
        o=orders,
        l=lines,
    ).select("order_dates_missing_in_dimdate", "line_dates_missing_in_dimdate", "o.*", "l.*")


def fallback_members(dwh: Tables) -> DataFrame:
    """How many facts point at a fixed member (informational)."""
    orders = dwh["fact_order"].agg(
        F.struct(
            count_if(F.col("customer_key") == -1).alias("order_unknown_customer"),
            count_if(F.col("shipping_geography_key") == -1).alias("order_unknown_ship_geo"),
        )
    )
    return _one_row(
        o=orders,
        line_unknown_product=_count(dwh["fact_order_line_item"].filter("product_key = -1")),
        fulfillment_unknown_location=_count(dwh["fact_fulfillment"].filter("location_key = -1")),
    ).select("o.*", "line_unknown_product", "fulfillment_unknown_location")


def staging_counts(stg: Tables) -> DataFrame:
    """Rows of every staging table with the number of columns it has."""
    counts = labelled_counts({table: stg[table] for table in schemas.STAGING}, "table_name", "row_count")
    widths = F.create_map(*[F.lit(x) for table in schemas.STAGING for x in (table, len(schemas.columns(table)))])
    return counts.withColumn("column_count", widths[F.col("table_name")])


def verify(stg: Tables, dwh: Tables) -> DataFrame:
    """Every check as (check, value, expected, ok)."""
    rows = []

    def expect(frame: DataFrame, expected: Mapping[str, str | int]) -> None:
        for column, want in expected.items():
            value = F.col(column).cast("decimal(28,2)")
            target = F.col(want) if isinstance(want, str) else F.lit(want)
            rows.append(
                frame.select(
                    F.lit(column).alias("check"), value.alias("value"), target.cast("decimal(28,2)").alias("expected")
                )
            )

    expect(members(dwh), {name: 1 for name in MEMBERS})
    expect(generated_dimensions(dwh), {"time_rows": 24})
    expect(orders_reconcile(stg, dwh), {"fact_order_rows": "stg_order_rows", "fact_total": "stg_total"})
    expect(children_reconcile(stg, dwh), {"fact_inventory_rows": "stg_inventory_rows"})
    expect(
        orphan_keys(dwh),
        {
            name: 0
            for name in (
                "order_dates_missing_in_dimdate",
                "line_dates_missing_in_dimdate",
                "order_null_customer_key",
                "order_null_ship_geo_key",
                "line_null_order_key",
                "line_null_product_key",
            )
        },
    )
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out.withColumn("ok", F.col("value") == F.col("expected"))


# --- reconciliation over a window --------------------------------------------------
def _days_from(dwh: Tables, since: date) -> DataFrame:
    days = dwh["dim_date"].filter(F.col("full_date") >= F.lit(since))
    return F.broadcast(days.select(F.col("date_key").alias("order_date_key")))


def _key(day: date) -> int:
    return int(day.strftime("%Y%m%d"))


def _lines_since(dwh: Tables, since: date) -> DataFrame:
    # The key predicate repeats the calendar filter so that it reaches the Parquet scan.
    lines = dwh["fact_order_line_item"].filter(F.col("order_date_key") >= _key(since))
    return lines.join(_days_from(dwh, since), "order_date_key")


def headline_lines(dwh: Tables, since: date) -> DataFrame:
    """Lines collapse per order first; products are counted by a scan of their own.

    Two distinct counts in one aggregate would triple every line before the shuffle.
    """
    lines = _lines_since(dwh, since)
    per_order = lines.groupBy("order_key").agg(
        F.sum("quantity_ordered").alias("qty"), F.sum("net_amount").alias("net")
    )
    return per_order.agg(
        F.count(F.lit(1)).alias("orders"), F.sum("qty").alias("units"), F.sum("net").alias("line_net_revenue")
    ).withColumn("products", lines.agg(F.countDistinct("product_key")).scalar())


def headline_orders(dwh: Tables, since: date) -> DataFrame:
    start = F.lit(since).cast("timestamp_ntz")
    return dwh["fact_order"].filter(F.col("order_created_at") >= start).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").alias("header_total_revenue"),
        F.sum("net_amount").alias("header_net_of_refunds"),
    )


def top_products(dwh: Tables, since: date, limit: int = 15) -> DataFrame:
    """Best sellers of the window; ties are ordered by product."""
    sums = (
        _lines_since(dwh, since)
        .groupBy("product_key")
        .agg(F.sum("net_amount").alias("net"), F.sum("quantity_ordered").alias("qty"))
    )
    products = dwh["dim_product"].select("product_key", "product_id", "product_title")
    return (
        sums.join(products, "product_key")
        .groupBy("product_id", "product_title")
        .agg(F.sum("net").alias("revenue"), F.sum("qty").alias("units"))
        .orderBy(F.desc("revenue"), "product_id")
        .limit(limit)
    )


def headline_view(dwh: Tables, since: date) -> DataFrame:
    """The headline through the product-day view. Its products are product ids, not variants."""
    return (
        views.revenue_by_product_by_day(dwh, since)
        .agg(
            F.countDistinct("product_id").alias("products"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("units").alias("total_units"),
        )
    )


def window_report(dwh: Tables, as_of: date, days: int = 60) -> DataFrame:
    return (
        views.revenue_by_product_by_day(dwh, as_of - timedelta(days=days))
        .agg(
            F.count(F.lit(1)).alias("product_day_rows"),
            F.countDistinct("order_date").alias("distinct_days"),
            F.countDistinct("product_id").alias("distinct_products"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("units").alias("total_units"),
        )
    )


def daily_trend(dwh: Tables, as_of: date, days: int = 14) -> DataFrame:
    return (
        views.revenue_by_product_by_day(dwh, as_of - timedelta(days=days))
        .groupBy("order_date")
        .agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), F.sum("orders").alias("orders"))
        .orderBy("order_date")
    )
