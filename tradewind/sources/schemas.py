"""Declared table schemas: staging, warehouse and voucher layer.

Every table is a column list in Spark DDL. The names, types and column order are
fixed values: they are the public interface that loads align to and queries use.
"""

from __future__ import annotations

import re

# --- fixed values: the 18 staging tables (234 columns) ------------------------
STAGING: dict[str, str] = {
    "stg_orders": (
        "id string, name string, email string, created_at timestamp_ntz, processed_at timestamp_ntz, "
        "updated_at timestamp_ntz, cancelled_at timestamp_ntz, closed_at timestamp_ntz, cancel_reason string, currency_code string, "
        "subtotal_price decimal(18,2), total_discounts decimal(18,2), total_tax decimal(18,2), total_shipping decimal(18,2), total_price decimal(18,2), "
        "total_refunded decimal(18,2), financial_status string, fulfillment_status string, customer_id string, shipping_address_json string, "
        "billing_address_json string, tags string, note string, source_name string, landing_site string, "
        "referring_site string, checkout_id string, extracted_at timestamp_ntz"
    ),
    "stg_order_line_items": (
        "id string, order_id string, variant_id string, product_id string, title string, "
        "variant_title string, sku string, quantity int, current_quantity int, unfulfilled_quantity int, "
        "unit_price decimal(18,2), total_price decimal(18,2), total_discount decimal(18,2), discounted_total decimal(18,2), is_gift_card boolean, "
        "taxable boolean, requires_shipping boolean, fulfillable_quantity int, extracted_at timestamp_ntz"
    ),
    "stg_order_transactions": (
        "id string, order_id string, kind string, status string, gateway string, "
        "amount decimal(18,2), currency_code string, created_at timestamp_ntz, processed_at timestamp_ntz, error_code string, "
        "extracted_at timestamp_ntz"
    ),
    "stg_order_tax_lines": (
        "order_id string, line_number int, title string, rate decimal(10,6), price decimal(18,2), "
        "extracted_at timestamp_ntz"
    ),
    "stg_order_discount_applications": (
        "order_id string, line_number int, discount_type string, code string, title string, "
        "description string, value_type string, value_amount decimal(18,2), value_percentage decimal(5,2), target_type string, "
        "allocation_method string, extracted_at timestamp_ntz"
    ),
    "stg_order_shipping_lines": (
        "id string, order_id string, title string, code string, source string, "
        "original_price decimal(18,2), discounted_price decimal(18,2), carrier_identifier string, extracted_at timestamp_ntz"
    ),
    "stg_fulfillments": (
        "id string, order_id string, status string, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "tracking_number string, tracking_company string, tracking_url string, location_id string, service string, "
        "shipment_status string, total_quantity int, extracted_at timestamp_ntz"
    ),
    "stg_fulfillment_line_items": (
        "fulfillment_id string, line_item_id string, quantity int, original_total decimal(18,2), discounted_total decimal(18,2), "
        "extracted_at timestamp_ntz"
    ),
    "stg_refunds": (
        "id string, order_id string, created_at timestamp_ntz, note string, total_refunded decimal(18,2), "
        "extracted_at timestamp_ntz"
    ),
    "stg_refund_line_items": (
        "refund_id string, line_item_id string, quantity int, restock_type string, location_id string, "
        "subtotal_amount decimal(18,2), total_tax_amount decimal(18,2), extracted_at timestamp_ntz"
    ),
    "stg_customers": (
        "id string, email string, phone string, first_name string, last_name string, "
        "email_marketing_state string, sms_marketing_state string, created_at timestamp_ntz, updated_at timestamp_ntz, number_of_orders int, "
        "amount_spent decimal(18,2), default_address_json string, tags string, note string, tax_exempt boolean, "
        "extracted_at timestamp_ntz"
    ),
    "stg_products": (
        "id string, title string, handle string, description string, product_type string, "
        "vendor string, status string, created_at timestamp_ntz, updated_at timestamp_ntz, published_at timestamp_ntz, "
        "tags string, extracted_at timestamp_ntz"
    ),
    "stg_product_variants": (
        "id string, product_id string, title string, sku string, barcode string, "
        "price decimal(18,2), compare_at_price decimal(18,2), cost decimal(18,2), taxable boolean, requires_shipping boolean, "
        "weight decimal(10,2), weight_unit string, option1 string, option2 string, option3 string, "
        "inventory_item_id string, created_at timestamp_ntz, updated_at timestamp_ntz, extracted_at timestamp_ntz"
    ),
    "stg_discount_codes": (
        "id string, code string, title string, discount_type string, status string, "
        "value_type string, value_amount decimal(18,2), value_percentage decimal(5,2), starts_at timestamp_ntz, ends_at timestamp_ntz, "
        "usage_limit int, usage_count int, applies_once_per_customer boolean, created_at timestamp_ntz, extracted_at timestamp_ntz"
    ),
    "stg_locations": (
        "id string, name string, address1 string, address2 string, city string, "
        "province string, province_code string, country string, country_code string, zip string, "
        "phone string, is_active boolean, fulfills_online_orders boolean, extracted_at timestamp_ntz"
    ),
    "stg_inventory_levels": (
        "inventory_item_id string, location_id string, available int, on_hand int, committed int, "
        "incoming int, reserved int, updated_at timestamp_ntz, snapshot_date date, extracted_at timestamp_ntz"
    ),
    "stg_abandoned_checkouts": (
        "id string, created_at timestamp_ntz, updated_at timestamp_ntz, completed_at timestamp_ntz, customer_id string, "
        "email string, phone string, subtotal_price decimal(18,2), total_tax decimal(18,2), total_price decimal(18,2), "
        "currency_code string, abandoned_checkout_url string, line_items_count int, line_items_json string, shipping_address_json string, "
        "extracted_at timestamp_ntz"
    ),
    "stg_gift_cards": (
        "id string, code string, initial_value decimal(18,2), balance decimal(18,2), currency_code string, "
        "enabled boolean, expires_on date, created_at timestamp_ntz, updated_at timestamp_ntz, disabled_at timestamp_ntz, "
        "customer_id string, order_id string, note string, extracted_at timestamp_ntz"
    ),
}

# --- fixed values: merge keys of the staging tables ---------------------------
STAGING_KEYS: dict[str, tuple[str, ...]] = {
    "stg_orders": ("id",),
    "stg_order_line_items": ("id",),
    "stg_order_transactions": ("id",),
    "stg_order_tax_lines": ("order_id", "line_number"),
    "stg_order_discount_applications": ("order_id", "line_number"),
    "stg_order_shipping_lines": ("id",),
    "stg_fulfillments": ("id",),
    "stg_fulfillment_line_items": ("fulfillment_id", "line_item_id"),
    "stg_refunds": ("id",),
    "stg_refund_line_items": ("refund_id", "line_item_id"),
    "stg_customers": ("id",),
    "stg_products": ("id",),
    "stg_product_variants": ("id",),
    "stg_discount_codes": ("id",),
    "stg_locations": ("id",),
    "stg_inventory_levels": ("inventory_item_id", "location_id", "snapshot_date"),
    "stg_abandoned_checkouts": ("id",),
    "stg_gift_cards": ("id",),
}

#: Children and facts of orders are dealt by their order, so that all rows of a changed order stand in one bucket.
BUCKET_KEYS: dict[str, tuple[str, ...]] = {
    t: ("order_id",)
    for t in (
        "stg_order_line_items", "stg_order_transactions", "stg_order_tax_lines", "stg_order_discount_applications",
        "stg_order_shipping_lines", "stg_fulfillments", "stg_refunds",
        "fact_order", "fact_order_line_item", "fact_fulfillment", "fact_refund",
    )
} | {"agg_product_day": ("order_date_key",)}

# --- fixed values: the warehouse tables ---------------------------------------
WAREHOUSE: dict[str, str] = {
    "dim_date": (
        "date_key int, full_date date, cal_year int, cal_quarter int, cal_month int, month_name string, "
        "week_of_year int, day_of_month int, day_of_week int, day_name string, is_weekend boolean, "
        "is_month_end boolean, fiscal_year int, fiscal_quarter int"
    ),
    "dim_time": (
        "time_key int, hour_24 int, hour_12 int, am_pm string, hour_label string, day_part string, "
        "is_business_hours boolean"
    ),
    "dim_customer": (
        "customer_key bigint, customer_id string, email string, first_name string, last_name string, "
        "full_name string, phone string, accepts_email_marketing boolean, accepts_sms_marketing boolean, "
        "customer_created_date date, default_country string, default_city string, tags string, "
        "membership_tier string, is_tax_exempt boolean, lifetime_order_count int, "
        "lifetime_revenue decimal(18,2), first_order_date date, last_order_date date, "
        "average_order_value decimal(18,2), days_since_last_order int, customer_segment string, "
        "rfm_recency_score int, rfm_frequency_score int, rfm_monetary_score int, rfm_combined_score int, "
        "rfm_segment string, loaded_at timestamp_ntz"
    ),
    "dim_product": (
        "product_key bigint, product_id string, variant_id string, sku string, barcode string, "
        "product_title string, variant_title string, full_title string, product_type string, vendor string, "
        "option_1_value string, option_2_value string, option_3_value string, current_price decimal(18,2), "
        "compare_at_price decimal(18,2), unit_cost decimal(18,2), is_on_sale boolean, "
        "discount_percentage decimal(6,2), is_taxable boolean, requires_shipping boolean, "
        "weight_grams decimal(12,2), product_status string, tags string, product_created_date date, "
        "loaded_at timestamp_ntz"
    ),
    "dim_geography": (
        "geography_key bigint, address_hash string, city string, province string, province_code string, "
        "country string, country_code string, postal_code string, region string, loaded_at timestamp_ntz"
    ),
    "dim_discount": (
        "discount_key bigint, discount_id string, discount_code string, discount_title string, "
        "discount_type string, value_type string, discount_value decimal(18,2), discount_status string, "
        "starts_at date, ends_at date, usage_limit int, current_usage_count int, "
        "is_one_per_customer boolean, loaded_at timestamp_ntz"
    ),
    "dim_location": (
        "location_key bigint, location_id string, location_name string, address string, city string, "
        "province string, country string, country_code string, is_active boolean, fulfills_online boolean, "
        "loaded_at timestamp_ntz"
    ),
    "fact_order": (
        "order_key bigint, order_date_key int, order_time_key int, customer_key bigint, "
        "shipping_geography_key bigint, billing_geography_key bigint, order_id string, order_number string, "
        "order_email string, checkout_id string, source_name string, landing_site string, "
        "referring_site string, order_created_at timestamp_ntz, order_processed_at timestamp_ntz, "
        "order_cancelled_at timestamp_ntz, order_closed_at timestamp_ntz, subtotal_amount decimal(18,2), "
        "shipping_amount decimal(18,2), tax_amount decimal(18,2), discount_amount decimal(18,2), "
        "total_amount decimal(18,2), refund_amount decimal(18,2), net_amount decimal(18,2), "
        "currency_code string, payment_1_gateway string, payment_1_amount decimal(18,2), "
        "payment_2_gateway string, payment_2_amount decimal(18,2), payment_3_gateway string, "
        "payment_3_amount decimal(18,2), total_payment_count int, tax_1_name string, "
        "tax_1_rate decimal(10,6), tax_1_amount decimal(18,2), tax_2_name string, tax_2_rate decimal(10,6), "
        "tax_2_amount decimal(18,2), discount_1_code string, discount_1_type string, "
        "discount_1_amount decimal(18,2), discount_2_code string, discount_2_type string, "
        "discount_2_amount decimal(18,2), primary_discount_key bigint, shipping_method string, "
        "shipping_carrier string, financial_status string, fulfillment_status string, cancel_reason string, "
        "is_paid boolean, is_fully_refunded boolean, is_cancelled boolean, is_fulfilled boolean, "
        "has_discount boolean, has_multiple_payments boolean, line_item_count int, total_quantity int, "
        "unique_product_count int, customer_email string, customer_name string, customer_segment string, "
        "is_first_order boolean, is_repeat_customer boolean, shipping_city string, shipping_province string, "
        "shipping_country string, shipping_country_code string, tags string, notes string, "
        "loaded_at timestamp_ntz"
    ),
    "fact_order_line_item": (
        "line_item_key bigint, order_key bigint, order_date_key int, order_time_key int, product_key bigint, "
        "customer_key bigint, line_item_id string, order_id string, order_number string, sku string, "
        "product_title string, variant_title string, product_type string, vendor string, "
        "quantity_ordered int, quantity_fulfilled int, quantity_refunded int, quantity_current int, "
        "unit_price decimal(18,2), unit_cost decimal(18,2), gross_amount decimal(18,2), "
        "discount_amount decimal(18,2), net_amount decimal(18,2), gross_margin decimal(18,2), "
        "gross_margin_percent decimal(8,2), is_gift_card boolean, is_taxable boolean, is_fulfilled boolean, "
        "is_partially_fulfilled boolean, is_refunded boolean, is_fully_refunded boolean, "
        "order_created_date date, order_financial_status string, order_fulfillment_status string, "
        "customer_email string, customer_name string, shipping_country string, "
        "shipping_country_code string, loaded_at timestamp_ntz"
    ),
    "fact_fulfillment": (
        "fulfillment_key bigint, order_key bigint, order_date_key int, fulfillment_date_key int, "
        "fulfillment_time_key int, location_key bigint, customer_key bigint, fulfillment_id string, "
        "order_id string, order_number string, order_created_at timestamp_ntz, "
        "fulfillment_created_at timestamp_ntz, fulfillment_updated_at timestamp_ntz, "
        "fulfillment_time_hours decimal(12,2), fulfillment_time_days decimal(12,2), tracking_number string, "
        "tracking_company string, tracking_url string, shipping_service string, fulfillment_status string, "
        "shipment_status string, is_successful boolean, is_pending boolean, total_quantity int, "
        "line_item_count int, location_name string, customer_email string, customer_name string, "
        "shipping_country string, is_same_day boolean, is_within_48h boolean, is_late boolean, "
        "loaded_at timestamp_ntz"
    ),
    "fact_refund": (
        "refund_key bigint, order_key bigint, order_date_key int, refund_date_key int, customer_key bigint, "
        "refund_id string, order_id string, order_number string, order_created_at timestamp_ntz, "
        "refund_created_at timestamp_ntz, days_to_refund int, refund_amount decimal(18,2), "
        "refund_subtotal decimal(18,2), refund_tax decimal(18,2), original_order_total decimal(18,2), "
        "refund_percentage decimal(8,2), total_items_refunded int, line_item_count int, "
        "items_restocked int, items_not_restocked int, refund_note string, is_full_refund boolean, "
        "is_partial_refund boolean, has_restock boolean, customer_email string, customer_name string, "
        "loaded_at timestamp_ntz"
    ),
    "fact_inventory_snapshot": (
        "inventory_snapshot_key bigint, snapshot_date_key int, product_key bigint, location_key bigint, "
        "inventory_item_id string, location_id string, snapshot_date date, available_quantity int, "
        "on_hand_quantity int, committed_quantity int, incoming_quantity int, reserved_quantity int, "
        "total_inventory int, sellable_inventory int, unit_cost decimal(18,2), "
        "inventory_cost_value decimal(18,2), unit_price decimal(18,2), inventory_retail_value decimal(18,2), "
        "sku string, product_title string, variant_title string, product_type string, vendor string, "
        "location_name string, location_country string, is_out_of_stock boolean, is_low_stock boolean, "
        "is_overstocked boolean, loaded_at timestamp_ntz"
    ),
}

# --- voucher and channel layer: staging, dimensions, facts, reference ----------
VOUCHER: dict[str, str] = {
    "stg_channels": (
        "channel_id string, channel_name string, industry string, contact_name string, contact_email string, "
        "contract_start_date date, contract_end_date date, is_active boolean, extracted_at timestamp_ntz"
    ),
    "stg_voucher_inventory": (
        "voucher_id string, voucher_code string, voucher_type string, channel_id string, "
        "face_value decimal(18,2), currency_code string, created_in_store_at timestamp_ntz, "
        "store_object_id string, status string, batch_id string, extracted_at timestamp_ntz"
    ),
    "stg_voucher_distributions": (
        "distribution_id string, voucher_id string, voucher_code string, channel_id string, "
        "instruction_date date, distribution_date timestamp_ntz, distribution_method string, "
        "recipient_phone string, recipient_name string, sms_status string, subscription_flag boolean, "
        "subscription_month int, extracted_at timestamp_ntz"
    ),
    "stg_campaign_segments": (
        "segment_id string, note string, serial string, code string, campaign string, client string, "
        "refund_reason string, commission_rate_id string"
    ),
    "dim_channel": (
        "channel_key bigint, channel_id string, channel_name string, industry string, "
        "contract_start_date date, contract_end_date date, is_active boolean, loaded_at timestamp_ntz"
    ),
    "dim_voucher": (
        "voucher_key bigint, voucher_code string, voucher_type string, channel_key bigint, "
        "campaign_name string, subscription_discount_pct decimal(5,2), subscription_term_months int, "
        "is_marketing boolean, face_value decimal(18,2), currency_code string, status string, "
        "batch_id string, created_in_store_at timestamp_ntz, store_discount_key bigint, "
        "is_distributed boolean, distribution_date timestamp_ntz, distribution_method string, "
        "is_subscription boolean, subscription_month int, is_redeemed boolean, "
        "redemption_date timestamp_ntz, redemption_order_id string, redeemed_amount decimal(18,2), "
        "expires_on date, days_in_inventory int, days_to_redemption int, channel_name string, "
        "loaded_at timestamp_ntz"
    ),
    "fact_voucher_lifecycle": (
        "voucher_lifecycle_key bigint, voucher_key bigint, channel_key bigint, creation_date_key int, "
        "distribution_date_key int, redemption_date_key int, expiry_date_key int, product_key bigint, "
        "voucher_code string, voucher_type string, batch_id string, lifecycle_status string, "
        "is_distributed boolean, is_redeemed boolean, is_expired boolean, is_dual_redemption boolean, "
        "face_value decimal(18,2), redemption_order_total decimal(18,2), "
        "redemption_discount_amount decimal(18,2), overspend decimal(18,2), breakage_amount decimal(18,2), "
        "days_creation_to_distribution int, days_distribution_to_redemption int, "
        "days_creation_to_redemption int, is_subscription boolean, subscription_month int, "
        "distribution_method string, channel_name string, redemption_order_number string, "
        "loaded_at timestamp_ntz"
    ),
    "fact_channel_daily": (
        "channel_daily_key bigint, channel_key bigint, date_key int, vouchers_created int, "
        "vouchers_distributed int, vouchers_redeemed int, vouchers_expired int, "
        "face_value_created decimal(18,2), face_value_distributed decimal(18,2), "
        "face_value_redeemed decimal(18,2), redemption_order_revenue decimal(18,2), "
        "overspend_total decimal(18,2), breakage_total decimal(18,2), cumulative_created bigint, "
        "cumulative_distributed bigint, cumulative_redeemed bigint, outstanding_distributed bigint, "
        "distribution_rate decimal(8,2), redemption_rate decimal(8,2), channel_name string, "
        "loaded_at timestamp_ntz"
    ),
    "ref_commission_rate": (
        "commission_rate_key bigint, channel_key bigint, rate_type string, rate_value decimal(8,4), "
        "effective_from date, effective_to date, loaded_at timestamp_ntz"
    ),
    "etl_state": (
        "entity string, last_sync_at timestamp_ntz, last_run_status string, records_processed bigint, "
        "updated_at timestamp_ntz"
    ),
    "etl_marks": "entity string, high_water timestamp_ntz, updated_at timestamp_ntz",
    "truncated_lists": "entity string, list_limit int, parents bigint, rows_cut bigint, cut_at_source bigint, updated_at timestamp_ntz",
    "retired_partitions": "table_name string, partition_value string, retired_at timestamp_ntz",
}


# --- aggregates kept beside the facts ------------------------------------------
DERIVED: dict[str, str] = {
    "agg_product_day": (
        "order_date_key int, order_date date, product_id string, product_title string, revenue decimal(28,2), units bigint, "
        "orders bigint"
    ),
}

#: How many payments, taxes and discounts of an order become columns of ``fact_order``.
PIVOT_WIDTHS = {"payments": 3, "taxes": 2, "discounts": 2}
_PIVOTED = {"payment": "payments", "tax": "taxes", "discount": "discounts"}


def _widened(declared: str) -> str:
    """``fact_order`` with its numbered columns repeated to PIVOT_WIDTHS, after the last declared group of each kind."""
    out, done = [], set()
    columns = re.split(r",\s*(?![^(]*\))", declared)
    for column in columns:
        match = re.match(r"(payment|tax|discount)_\d+_", column)
        if not match:
            out.append(column)
        elif match[1] not in done:
            done.add(match[1])
            group = [c for c in columns if c.startswith(f"{match[1]}_1_")]
            out += [c.replace("_1_", f"_{i}_", 1) for i in range(1, PIVOT_WIDTHS[_PIVOTED[match[1]]] + 1) for c in group]
    return ", ".join(out)


def ddl(table: str) -> str:
    if table.startswith("keys_"):  # a key registry
        return "natural_key string, surrogate_key bigint"
    table = table.removesuffix("_overflow")  # the rows beyond a list's limit
    if table == "fact_order":
        return _widened(WAREHOUSE[table])
    for group in (STAGING, WAREHOUSE, VOUCHER, DERIVED):
        if table in group:
            return group[table]
    raise KeyError(f"no declared table {table!r}")


def columns(table: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a declared table, in order."""
    return [tuple(field.split(" ", 1)) for field in ddl(table).split(", ")]
