"""Registered queries for catalogue metrics, rules, vouchers and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import id_digits
from tradewind.operators import rules
from tradewind.plans import dimensions, metrics, reports, vouchers
from tradewind.plans.contract import of_table
from tradewind.plans.registry import LAST_ORDER_DAY, register
from tradewind.plans.warehouse import TEST_AS_OF, Warehouse
from tradewind.session import scratch_path
from tradewind.sources import schemas, segments
from tradewind.sources.tables import TableStore

# --- catalogue metrics --------------------------------------------------------------
register("me01_sales_growth", metrics.sales_growth, "month:i revenue:m prior_revenue:m growth_rate:r")
register(
    "me02_retention_churn",
    metrics.retention,
    "month:i customers_at_start:i customers_at_end:i new_customers:i lost_customers:i retention_rate:r churn_rate:r",
)
register(
    "me04_cohorts",
    metrics.cohorts,
    "cohort:i age:i cohort_size:i active_customers:i revenue:m retention_rate:r revenue_per_member:r",
)
register(
    "me05_purchase_rhythm",
    metrics.purchase_rhythm,
    "orders:i customers:i purchase_frequency:r avg_days_between_orders:r",
)
register("me06_customer_gaps", metrics.customer_gaps, "customer_key:i orders:i avg_days_between_orders:r")
register(
    "me07_product_return_rate",
    lambda w: metrics.product_return_rate(w.stg, w),
    "product_key:i units_sold:i units_refunded:i return_rate:r",
)
register(
    "me08_sell_through",
    lambda w: metrics.sell_through(w, date(2001, 1, 1), date(2001, 12, 31)),
    "product_key:i opening_units:i units_sold:i sell_through_rate:r",
)
register(
    "me09_inventory_turnover",
    lambda w: metrics.inventory_turnover(w, 2000),
    "cogs:m average_inventory_value:r inventory_turnover:r days_of_inventory:r",
)
register("me10_revenue_contribution", metrics.revenue_contribution, "product_key:i revenue:m contribution:r")
register(
    "me11_stock_out_days", metrics.stock_out_days, "inventory_item_id:s location_id:s days:i days_out:i stock_out_share:r"
)
register("me12_dead_stock", lambda w: metrics.dead_stock(w, date(2001, 5, 1)), "dead_value:m total_value:m dead_share:r")
register("me13_sales_velocity", metrics.sales_velocity, "product_key:i units_sold:i days_sold:i units_per_day:r")
register(
    "me14_discount_penetration",
    metrics.discount_penetration,
    "discounted_revenue:m total_revenue:m discount_penetration:r",
)
register(
    "me15_order_return_rates",
    metrics.order_return_rates,
    "orders:i refunded_orders:i returned_orders:i refund_rate:r return_rate:r",
)
register("me15_tax_by_region", metrics.tax_by_region, "shipping_country:s tax_collected:m orders:i")
register(
    "me16_revenue_by_landing_site",
    lambda w: metrics.revenue_by_site(w["fact_order"], "landing_site", "PATH"),
    "site:s orders:i revenue:m",
)
register(
    "me16_revenue_by_referring_site",
    lambda w: metrics.revenue_by_site(w["fact_order"], "referring_site", "HOST"),
    "site:s orders:i revenue:m",
)
register(
    "me17_recovered_checkouts",
    lambda w: metrics.recovered_checkouts(w.stg["stg_abandoned_checkouts"]),
    "recovered:i abandoned:i recovery_rate:r",
)
register(
    "me18_profit",
    lambda w: metrics.profit(w.stg, w),
    "product_key:i month:i revenue:m cogs:m refunds:m gross_profit:m gross_margin_percent:r contribution:m contribution_margin_percent:r",
)
register(
    "me19_rfm_segments", metrics.rfm_segments, "rfm_segment:s customer_count:i total_revenue:m avg_aov:r avg_recency:r"
)

# --- rules ----------------------------------------------------------------------------
register(
    "cf01_payment_pivot",
    lambda w: rules.payment_pivot(w.stg["stg_order_transactions"]),
    "order_id:s payment_card_payments_amount:m payment_gift_card_amount:m payment_paypal_amount:m payment_manual_amount:m "
    "payment_method_count:i",
)
register(
    "cf02_tax_pivot",
    lambda w: rules.tax_pivot(w.stg["stg_order_tax_lines"]),
    "order_id:s tax_vat_rate:r tax_vat_amount:m tax_levy_rate:r tax_levy_amount:m",
)
register(
    "cf03_discount_pivot",
    lambda w: rules.discount_pivot(w.stg["stg_order_discount_applications"]),
    "order_id:s discount_voucher_code:s discount_voucher_amount:m discount_promotion_code:s discount_promotion_amount:m "
    "discount_staff_code:s discount_staff_amount:m discount_manual_code:s discount_manual_amount:m",
)


def rule_segments(w: Warehouse) -> DataFrame:
    people = w["dim_customer"].filter("customer_key > 0")
    aged = people.withColumn("days_since_first_order", F.datediff(F.lit(w.as_of), F.col("first_order_date")))
    return aged.groupBy(rules.segment().alias("segment")).agg(F.count(F.lit(1)).alias("customers"))


def tag_columns(w: Warehouse) -> DataFrame:
    return w["fact_order"].select("order_id", *rules.tag_flags(F.col("tags")))


def customer_tag_columns(w: Warehouse) -> DataFrame:
    return w["dim_customer"].filter("customer_key > 0").select(
        "customer_id", *rules.tag_flags(F.col("tags"), rules.CUSTOMER_TAGS, whole=True)
    )


def by_region(w: Warehouse) -> DataFrame:
    place = rules.region(F.col("shipping_country_code"))
    return w["fact_order"].groupBy(place.alias("region")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue")
    )


def fiscal_quarters(w: Warehouse) -> DataFrame:
    """Orders by quarter of a fiscal year that starts in March."""
    days = w["dim_date"].select(
        "date_key",
        dimensions.fiscal_year(F.col("full_date"), 3).alias("fiscal_year"),
        dimensions.fiscal_quarter(F.col("full_date"), 3).alias("fiscal_quarter"),
    )
    daily = w["fact_order"].groupBy("order_date_key").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount"))
    return (
        daily.join(F.broadcast(days), F.col("order_date_key") == F.col("date_key"))
        .groupBy("fiscal_year", "fiscal_quarter")
        .agg(F.sum("n").alias("orders"), F.sum("amount").alias("revenue"))
    )


# Product types of the generated parts
PART_CATEGORIES = {"Value": ("ECONOMY", "SMALL", "PROMO"), "Core": ("STANDARD", "MEDIUM", "LARGE")}


def by_category(w: Warehouse) -> DataFrame:
    lines = w["fact_order_line_item"]
    return lines.groupBy(rules.category(F.col("product_type"), PART_CATEGORIES).alias("category")).agg(
        F.sum("net_amount").alias("revenue"), F.sum("quantity_ordered").alias("units")
    )


register("cf04_rule_segments", rule_segments, "segment:s customers:i")
register("cf05_order_tag_flags", tag_columns, "order_id:s is_vip_order:b is_b2b_order:b is_gift:b")
register("cf05_customer_tag_flags", customer_tag_columns, "customer_id:s is_wholesale:b is_vip:b")
register("cf06_regions", by_region, "region:s orders:i revenue:m")
register(
    "cf07_option_aliases",
    lambda w: rules.option_aliases(w.stg["stg_product_variants"].select("id", "option1", "option2", "option3")),
    "id:s size:s color:s material:s",
)
register("cf08_fiscal_quarters", fiscal_quarters, "fiscal_year:i fiscal_quarter:i orders:i revenue:m")
register("cf09_categories", by_category, "category:s revenue:m units:i")
def retained_orders(w: Warehouse, soft: bool = False) -> TableStore:
    """Orders stored by month, after the months before the window have been removed (or retired)."""
    store = TableStore(w.spark, scratch_path(w.spark, "retention"))
    month = F.year("created_at") * 100 + F.month("created_at")
    store.load_full("stg_orders", w.stg["stg_orders"], partition_by=("month", month.cast("int")))
    rules.apply_retention(store, "stg_orders", TEST_AS_OF, months=24, soft=soft)
    return store


register(
    "cf10_retention_window",
    lambda w: rules.within_retention(retained_orders(w).read("stg_orders"), "created_at", TEST_AS_OF, months=24).agg(
        F.count(F.lit(1)).alias("orders"), F.min("created_at").alias("oldest")
    ),
    "orders:i oldest:t",
)
register(
    "cf10_retained_months",
    lambda w: retained_orders(w).read("stg_orders", hidden=["month"]).groupBy("month").agg(F.count(F.lit(1)).alias("orders")),
    "month:i orders:i",
)
register(
    "cf10_retired_months",
    lambda w: retained_orders(w, soft=True).read("stg_orders", hidden=["month"]).groupBy("month").agg(F.count(F.lit(1)).alias("orders")),
    "month:i orders:i",
)
register(
    "cf12_gateways_in_use", lambda w: rules.distinct_values(w.stg["stg_order_transactions"], "gateway"), "gateway:s"
)
register(
    "cf13_carrier_pivot",
    lambda w: rules.carrier_pivot(w.stg["stg_order_shipping_lines"]),
    "order_id:s shipping_standard_method:s shipping_standard_amount:m shipping_express_method:s shipping_express_amount:m "
    "shipping_collect_method:s shipping_collect_amount:m",
)
register(
    "cf14_status_flags",
    lambda w: w.stg["stg_orders"].select("id", *rules.status_flags()),
    "id:s is_paid:b is_fully_refunded:b is_fulfilled:b is_partially_fulfilled:b",
)

# --- voucher layer --------------------------------------------------------------------
for _key, _table in (
    ("vc02", "dim_channel"),
    ("vc03", "dim_voucher"),
    ("vc08", "fact_voucher_lifecycle"),
    ("vc10", "fact_channel_daily"),
):
    register(f"{_key}_{_table}", lambda w, t=_table: w[t], of_table(_table))
register(
    "vc01_voucher_staging",
    lambda w: w.stg["stg_voucher_inventory"]
    .join(w.stg["stg_voucher_distributions"].select("voucher_id", "distribution_id", "sms_status"), "voucher_id", "left")
    .join(w.stg["stg_channels"].select("channel_id", "industry"), "channel_id", "left")
    .select("voucher_id", "voucher_code", "voucher_type", "channel_id", "face_value", "distribution_id", "sms_status", "industry"),
    "voucher_id:s voucher_code:s voucher_type:s channel_id:s face_value:m distribution_id:s sms_status:s industry:s",
)
register(
    "vc04_discount_redemptions",
    lambda w: vouchers.discount_redemptions(w.stg),
    "voucher_code:s redemption_order_id:s redemption_date:t redeemed_amount:m total_price:m",
)
register(
    "vc05_card_matches",
    lambda w: vouchers.card_matches(w.stg),
    "voucher_code:s channel_id:s id:s initial_value:m balance:m redeemed_amount:m",
)
register(
    "vc06_campaign_terms",
    lambda w: w.stg["stg_campaign_segments"].select(
        "segment_id",
        vouchers.subscription_percent(F.col("campaign")).alias("percent"),
        vouchers.subscription_months(F.col("campaign")).alias("months"),
    ),
    "segment_id:s percent:m months:i",
)
register(
    "vc07_refund_segments",
    lambda w: vouchers.normalise_segments(w.stg["stg_campaign_segments"]),
    "segment_id:s code:s campaign:s client:s refund_reason:s is_refund:b",
)
register(
    "vc09_dual_redemption_orders", lambda w: vouchers.dual_redemption_orders(w.stg), "redemption_order_id:s"
)
register(
    "vc12_order_payment_split",
    lambda w: vouchers.order_payment_split(w.stg, w),
    "order_key:i order_number:s order_date_key:i customer_key:i gc_amount:m discount_amount:m cash_amount:m total_amount:m "
    "has_gift_card:b has_discount_code:b is_dual_redemption:b voucher_code:s voucher_key:i channel_key:i channel_name:s",
)
register("vc13_commission_rates", lambda w: w["ref_commission_rate"], of_table("ref_commission_rate"))


def rate_history(w: Warehouse) -> DataFrame:
    """New rates for every even channel from 2001, applied twice."""
    current = w["ref_commission_rate"].select("channel_key", "rate_type", "rate_value", "effective_from", "effective_to")
    changes = w["dim_channel"].filter("channel_key > 0 and channel_key % 2 = 0").select(
        "channel_key",
        F.lit("commission").alias("rate_type"),
        F.lit("0.3").cast("decimal(8,4)").alias("rate_value"),
        F.when(F.col("channel_key") % 4 == 0, F.lit("1995-06-01")).otherwise(F.lit("2001-01-01")).cast("date").alias("effective_from"),
    )
    return vouchers.apply_rate_changes(vouchers.apply_rate_changes(current, changes), changes)


register(
    "vc13_rate_history", rate_history, "channel_key:i rate_type:s rate_value:r effective_from:d effective_to:d"
)
register(
    "vc14_provisional_billing",
    lambda w: vouchers.provisional_billing(w["fact_voucher_lifecycle"], w["ref_commission_rate"]),
    "channel_name:s quantity:i redeemed_vouchers:i voucher_base:m sales_revenue:m provisional_billing:r redemption_rate:r margin:r",
)
register(
    "vc15_channel_metrics",
    lambda w: vouchers.channel_metrics(w["fact_voucher_lifecycle"], w.stg["stg_voucher_distributions"], w["dim_channel"]),
    "channel_name:s vouchers_created:i vouchers_distributed:i vouchers_redeemed:i vouchers_expired:i distribution_rate:r "
    "redemption_rate:r outstanding_vouchers:i face_value_distributed:m face_value_redeemed:m redemption_order_revenue:m "
    "overspend_total:m upsell_rate:r outstanding_liability:r breakage_total:m avg_days_in_inventory:r avg_days_to_redeem:r "
    "avg_total_lifecycle:r subscription_vouchers:i subscription_redemption_rate:r subscription_tenure:i sms_count:i "
    "direct_count:i sms_delivery_rate:r",
)
register(
    "vc16_redemption_anomalies",
    lambda w: vouchers.redemption_anomalies(w["fact_channel_daily"]),
    "channel_name:s date_key:i vouchers_redeemed:i avg_before:r ratio:r",
)
for _period in ("this_month", "last_month", "this_quarter", "ytd"):
    register(
        f"vc17_summary_{_period}",
        lambda w, p=_period: vouchers.channel_summary(w["fact_channel_daily"], p, date(2001, 3, 15)),
        "channel_name:s distributed:i redeemed:i redemption_pct:r face_value_redeemed:m overspend:m revenue:m outstanding:i",
    )
register(
    "vc18_outstanding_liability",
    lambda w: vouchers.outstanding_liability(w["fact_channel_daily"]),
    "channel_name:s outstanding_vouchers:i estimated_liability:r",
)
register(
    "vc19_channel_rows",
    lambda w: vouchers.channel_rows(w["fact_voucher_lifecycle"], "NATION_3").select(
        "voucher_code", "lifecycle_status", "face_value"
    ),
    "voucher_code:s lifecycle_status:s face_value:m",
)


def segment_csv(w: Warehouse) -> DataFrame:
    """The segment list written as CSV with line breaks in its notes, and read back."""
    path = scratch_path(w.spark, "segments")
    note = F.concat(F.lit('Original order: "'), id_digits(F.col("segment_id")), F.lit('"\nRefund, original order'))
    segments.write_segments(w.stg["stg_campaign_segments"].withColumn("note", note), path)
    return segments.read_segments(w.spark, path)


register(
    "vc20_segment_csv", segment_csv, "segment_id:s note:s serial:s code:s campaign:s client:s refund_reason:s"
)

# --- reports --------------------------------------------------------------------------
def order_comparison(w: Warehouse) -> DataFrame:
    """The warehouse against the raw order table: test orders with a zero total differ."""
    raw = w.base["orders"].select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("total")
    )
    ours = w["fact_order"].select("order_id", F.col("total_amount").alias("total"))
    return reports.compare_orders(ours, raw, "order_id", "total")


def sku_presence(w: Warehouse) -> DataFrame:
    """SKUs sold against SKUs in the catalogue."""
    sold = w["fact_order_line_item"].filter("sku is not null").select("sku")
    listed = w["dim_product"].filter("sku is not null").select("sku")
    return reports.presence(sold, listed, "sku")


register("rp01_order_comparison", order_comparison, "order_id:s left_value:m right_value:m state:s")
register("rp02_sku_presence", sku_presence, "sku:s present_in:s")
register(
    "rp03_missing_contact",
    lambda w: reports.missing_contact(w.stg["stg_customers"], ["phone", "email"]).select("id", "email", "phone"),
    "id:s email:s phone:s",
)
register("rp04_order_volume_daily", lambda w: reports.order_volume(w, "day"), "period:d orders:i")
register("rp04_order_volume_monthly", lambda w: reports.order_volume(w, "month"), "period:d orders:i")
for _unit in ("day", "month"):
    register(
        f"rp05_tender_by_{_unit}",
        lambda w, u=_unit: reports.revenue_by_tender(vouchers.order_payment_split(w.stg, w), u),
        "period:i orders:i total_revenue:m gift_card_spend:m discount_spend:m cash_spend:m cash_percent:r",
    )
MONTHS = reports.month_range(LAST_ORDER_DAY, 6)
_month_columns = " ".join(f"m{k}:i" for k in MONTHS)
register(
    "rp06_redemption_trend",
    lambda w: reports.redemption_trend(w["fact_voucher_lifecycle"], LAST_ORDER_DAY),
    f"channel_name:s {_month_columns}",
)
register(
    "rp07_multiple_redemptions",
    lambda w: reports.multiple_redemptions(w["fact_voucher_lifecycle"]),
    "channel_name:s voucher_type:s redeemed_vouchers:i face_value:m total_amount:m",
)
register(
    "rp08_popular_products",
    lambda w: reports.popular_products(w, LAST_ORDER_DAY),
    f"product_key:i full_title:s {_month_columns} total_units:i",
)
register(
    "rp09_least_products",
    lambda w: reports.least_products(w, LAST_ORDER_DAY),
    f"product_key:i full_title:s {_month_columns} total_units:i",
)
register("rp10_new_products", reports.new_products, "product_created_date:d product_status:s variants:i skus:i")
register(
    "rp11_brand_channel_sales",
    lambda w: reports.brand_channel_sales(w, "Brand#4", "NATION_3"),
    "sku:s product_title:s quantity:i total_cost:m total_price:m",
)
register(
    "rp12_membership_orders",
    lambda w: reports.membership_orders(w, list(dimensions.MEMBERSHIP_TIERS.values())),
    "month:i standard_bank_platinum:i standard_bank_gold:i standard_bank_silver:i",
)
register(
    "rp13_incomplete_redemptions",
    lambda w: reports.incomplete_redemptions(w["dim_voucher"]),
    "voucher_code:s voucher_type:s redemption_date:t redemption_order_id:s campaign_name:s channel_name:s",
)
