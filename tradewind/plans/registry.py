"""Every registered query: what it computes and the columns it shows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.plans import checks, views
from tradewind.plans.contract import Contract, contract, of_table, present
from tradewind.plans.warehouse import Warehouse, open_generated
from tradewind.sources import schemas


@dataclass(frozen=True)
class Query:
    build: Callable[[Warehouse], DataFrame]
    shown: Contract

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return present(self.build(open_generated(spark, folder)), self.shown)


QUERIES: dict[str, Query] = {}


def register(name: str, build: Callable[[Warehouse], DataFrame], shown: str | Contract) -> None:
    QUERIES[name] = Query(build, contract(shown) if isinstance(shown, str) else shown)


# Calendar and clock are shown whole, with a flag for the members that orders use.
_USED_BY = {"dim_date": ("date_key", "order_date_key"), "dim_time": ("time_key", "order_time_key")}


def with_use(w: Warehouse, table: str) -> DataFrame:
    if table not in _USED_BY:
        return w[table]
    key, used = _USED_BY[table]
    keys = w["fact_order"].select(F.col(used).alias(key)).distinct().withColumn("in_use", F.lit(True))
    return w[table].join(keys, key, "left").withColumn("in_use", F.coalesce("in_use", F.lit(False)))


# --- warehouse builds -------------------------------------------------------------
for number, table in enumerate(schemas.WAREHOUSE, start=1):
    order = (
        "dim_date dim_time dim_product dim_customer dim_geography dim_discount dim_location fact_order "
        "fact_order_line_item fact_fulfillment fact_refund fact_inventory_snapshot"
    ).split()
    register(f"dw{order.index(table) + 1:02d}_{table}", lambda w, t=table: with_use(w, t), of_table(table) + ([("in_use", "b")] if table in _USED_BY else []))

# --- metric views -----------------------------------------------------------------
_ORDER = (
    "order_key:i order_date:d cal_year:i cal_quarter:i cal_month:i month_name:s day_name:s is_weekend:b order_hour:i "
    "day_part:s order_number:s order_created_at:t channel:s financial_status:s fulfillment_status:s is_paid:b "
    "is_cancelled:b is_first_order:b is_repeat_customer:b has_discount:b customer_key:i customer_name:s customer_email:s "
    "customer_segment:s membership_tier:s rfm_segment:s shipping_city:s shipping_province:s shipping_country:s "
    "shipping_country_code:s discount_code:s subtotal_amount:m shipping_amount:m tax_amount:m discount_amount:m "
    "total_amount:m refund_amount:m net_amount:m line_item_count:i total_quantity:i unique_product_count:i "
    "currency_code:s landing_site:s referring_site:s"
)
register("mv01_order_enriched", views.order_enriched, _ORDER)
register(
    "mv02_order_line_enriched",
    views.order_line_enriched,
    "line_item_key:i order_key:i order_date:d cal_year:i cal_quarter:i cal_month:i month_name:s product_key:i product_id:s "
    "sku:s product_title:s variant_title:s product_type:s vendor:s quantity_ordered:i quantity_refunded:i unit_price:m "
    "unit_cost:m gross_amount:m discount_amount:m net_amount:m line_cogs:m gross_margin:m gross_margin_percent:m "
    "is_gift_card:b order_financial_status:s customer_email:s shipping_country:s",
)
register(
    "mv03_sales_daily",
    views.sales_daily,
    "order_date:d cal_year:i cal_quarter:i cal_month:i month_name:s day_name:s is_weekend:b order_count:i total_revenue:m "
    "average_order_value:r gross_revenue:m net_line_revenue:m net_revenue_after_refunds:m units_sold:i "
    "units_per_transaction:r tax_collected:m shipping_revenue:m discount_amount:m refund_amount:m",
)
register(
    "mv04_channel_performance",
    views.channel_performance,
    "channel:s order_count:i total_revenue:m average_order_value:r units_sold:i",
)
register(
    "mv05_customer_metrics",
    views.customer_metrics,
    "customer_key:i customer_id:s full_name:s email:s customer_segment:s membership_tier:s customer_lifetime_value:m "
    "lifetime_order_count:i average_order_value:m first_order_date:d last_order_date:d days_since_last_order:i "
    "rfm_recency_score:i rfm_frequency_score:i rfm_monetary_score:i rfm_combined_score:i rfm_segment:s",
)
register(
    "mv06_customer_summary",
    views.customer_summary,
    "total_customers:i repeat_customers:i repeat_purchase_rate:r avg_lifetime_value:r new_customer_revenue:m "
    "returning_customer_revenue:m",
)
register(
    "mv07_product_performance",
    views.product_performance,
    "product_key:i product_id:s product_title:s product_type:s vendor:s sku:s units_sold:i product_revenue:m "
    "gross_revenue:m average_selling_price:r cogs:m gross_margin:m gross_margin_percent:r",
)
register(
    "mv08_discount_summary",
    views.discount_summary,
    "total_orders:i discounted_orders:i discount_usage_rate:r total_discount_amount:m avg_discount_per_order:r",
)
register(
    "mv09_discount_code_performance",
    views.discount_code_performance,
    "discount_code:s orders_using_code:i revenue_with_code:m discount_given:m usage_count:i usage_limit:i redemption_rate:r",
)
register(
    "mv10_fulfillment_performance",
    views.fulfillment_performance,
    "location_name:s fulfillment_count:i avg_fulfillment_hours:r avg_fulfillment_days:r same_day_rate:r on_time_rate:r late_rate:r",
)
register(
    "mv11_refund_analysis",
    views.refund_analysis,
    "refund_count:i total_refund_amount:m items_refunded:i restock_rate:r refund_rate_orders:r refund_percent_of_revenue:r",
)
register(
    "mv12_inventory_status",
    views.inventory_status,
    "product_key:i sku:s product_title:s variant_title:s product_type:s vendor:s location_name:s snapshot_date:d "
    "available_quantity:i on_hand_quantity:i committed_quantity:i inventory_cost_value:m inventory_retail_value:m "
    "is_out_of_stock:b is_low_stock:b is_overstocked:b",
)
register(
    "mv13_inventory_summary",
    views.inventory_summary,
    "sku_location_count:i out_of_stock_count:i stock_out_rate:r total_inventory_cost_value:m total_inventory_retail_value:m",
)
register(
    "mv14_abandoned_checkout_summary",
    lambda w: views.abandoned_checkout_summary(w.stg["stg_abandoned_checkouts"]),
    "abandoned_count:i completed_count:i abandonment_rate:r",
)
register(
    "mv15_revenue_by_product_by_day",
    views.revenue_by_product_by_day,
    "order_date:d product_id:s product_title:s revenue:m units:i orders:i",
)

# --- verification and reconciliation ------------------------------------------------
# fixed value: start of the reconciliation window over the generated orders
WINDOW_START = date(2001, 1, 1)
LAST_ORDER_DAY = date(2001, 8, 1)

register("vf1_warehouse_counts", checks.warehouse_counts, "obj:s n:i")
register(
    "vf2_generated_dimensions",
    checks.generated_dimensions,
    "min_date:d max_date:d days:i time_rows:i min_key:i max_key:i orders_outside:i",
)
register(
    "vf3_members",
    checks.members,
    "unknown_product:i unknown_customer:i unknown_geography:i unknown_location:i no_discount:i",
)
register(
    "vf4_orders_reconcile",
    lambda w: checks.orders_reconcile(w.stg, w),
    "fact_order_rows:i stg_order_rows:i fact_total:m stg_total:m",
)
register(
    "vf5_lines_reconcile",
    lambda w: checks.lines_reconcile(w.stg, w),
    "fact_line_rows:i stg_line_rows:i fact_net:m stg_net:m",
)
register(
    "vf6_children_reconcile",
    lambda w: checks.children_reconcile(w.stg, w),
    "fact_fulfillment_rows:i stg_fulfillment_rows:i fact_refund_rows:i stg_refund_rows:i fact_inventory_rows:i stg_inventory_rows:i",
)
register(
    "vf7_orphan_keys",
    checks.orphan_keys,
    "order_dates_missing_in_dimdate:i line_dates_missing_in_dimdate:i order_null_customer_key:i order_null_ship_geo_key:i "
    "line_null_order_key:i line_null_product_key:i",
)
register(
    "vf8_fallback_members",
    checks.fallback_members,
    "order_unknown_customer:i order_unknown_ship_geo:i line_unknown_product:i fulfillment_unknown_location:i",
)
register("vf9_staging_counts", lambda w: checks.staging_counts(w.stg), "table_name:s row_count:i column_count:i")
register(
    "rc1_headline_lines",
    lambda w: checks.headline_lines(w, WINDOW_START),
    "orders:i products:i units:i line_net_revenue:m",
)
register(
    "rc2_headline_orders",
    lambda w: checks.headline_orders(w, WINDOW_START),
    "orders:i header_total_revenue:m header_net_of_refunds:m",
)
register(
    "rc3_top_products", lambda w: checks.top_products(w, WINDOW_START), "product_id:s product_title:s revenue:m units:i"
)
register(
    "rc4_headline_view", lambda w: checks.headline_view(w, WINDOW_START), "products:i total_revenue:m total_units:i"
)
register(
    "rc5_window_report",
    lambda w: checks.window_report(w, LAST_ORDER_DAY),
    "product_day_rows:i distinct_days:i distinct_products:i total_revenue:m total_units:i",
)
register(
    "rc6_daily_trend", lambda w: checks.daily_trend(w, LAST_ORDER_DAY), "order_date:d revenue:m units:i orders:i"
)
