"""One statement per registered query."""

from __future__ import annotations

from oracle import staging, warehouse  # noqa: F401  (they define the shared expressions)
from oracle import business, more
from oracle.sql import half_up, present, rate, statement, units
from tradewind.queries import QUERIES
from tradewind.sources import schemas

BODIES: dict[str, str] = {}

for _name in QUERIES:
    if _name.startswith("dw"):
        BODIES[_name] = f"SELECT * FROM {_name[5:]}"

_dated = "JOIN dim_date d ON d.date_key = f.order_date_key"

BODIES["mv01_order_enriched"] = f"""
SELECT f.*, d.full_date AS order_date, d.cal_year, d.cal_quarter, d.cal_month, d.month_name, d.day_name, d.is_weekend,
       t.hour_24 AS order_hour, t.day_part, f.source_name AS channel, c.membership_tier, c.rfm_segment,
       f.discount_1_code AS discount_code
FROM fact_order f {_dated} LEFT JOIN dim_time t ON t.time_key = f.order_time_key
LEFT JOIN dim_customer c ON c.customer_key = f.customer_key"""

BODIES["mv02_order_line_enriched"] = f"""
SELECT f.*, d.full_date AS order_date, d.cal_year, d.cal_quarter, d.cal_month, d.month_name, p.product_id,
       f.quantity_ordered * f.unit_cost AS line_cogs
FROM fact_order_line_item f {_dated} LEFT JOIN dim_product p ON p.product_key = f.product_key"""

BODIES["mv03_sales_daily"] = f"""
SELECT d.full_date AS order_date, d.cal_year, d.cal_quarter, d.cal_month, d.month_name, d.day_name, d.is_weekend,
       coalesce(n, 0) AS order_count, h.total_revenue, {rate('h.total_revenue', 'n')} AS average_order_value, l.gross_revenue,
       l.net_line_revenue, h.net_after AS net_revenue_after_refunds, l.units_sold, {rate('l.units_sold', 'n')} AS units_per_transaction,
       h.tax AS tax_collected, h.shipping AS shipping_revenue, h.discounts AS discount_amount, h.refunds AS refund_amount
FROM dim_date d
LEFT JOIN (SELECT order_date_key AS k, count(*) AS n, sum(total_amount) AS total_revenue, sum(net_amount) AS net_after,
                  sum(tax_amount) AS tax, sum(shipping_amount) AS shipping, sum(discount_amount) AS discounts, sum(refund_amount) AS refunds
           FROM fact_order GROUP BY 1) AS h ON h.k = d.date_key
LEFT JOIN (SELECT order_date_key AS k, sum(gross_amount) AS gross_revenue, sum(net_amount) AS net_line_revenue,
                  sum(quantity_ordered) AS units_sold FROM fact_order_line_item GROUP BY 1) AS l ON l.k = d.date_key
WHERE coalesce(h.k, l.k) IS NOT NULL"""

BODIES["mv04_channel_performance"] = f"""
SELECT coalesce(source_name, '(unknown)') AS channel, count(*) AS order_count, sum(total_amount) AS total_revenue,
       {rate('sum(total_amount)', 'count(*)')} AS average_order_value, sum(total_quantity) AS units_sold
FROM fact_order GROUP BY source_name"""

BODIES["mv05_customer_metrics"] = """
SELECT *, lifetime_revenue AS customer_lifetime_value FROM dim_customer WHERE customer_key > 0"""

BODIES["mv06_customer_summary"] = f"""
SELECT count(*) AS total_customers, count(*) FILTER (lifetime_order_count >= 2) AS repeat_customers,
       {rate('count(*) FILTER (lifetime_order_count >= 2)', 'count(*)', '100')} AS repeat_purchase_rate,
       {rate('sum(lifetime_revenue)', 'count(lifetime_revenue)')} AS avg_lifetime_value,
       (SELECT sum(total_amount) FROM fact_order WHERE is_first_order) AS new_customer_revenue,
       (SELECT sum(total_amount) FROM fact_order WHERE NOT is_first_order) AS returning_customer_revenue
FROM dim_customer WHERE customer_key > 0"""

BODIES["mv07_product_performance"] = f"""
SELECT p.product_key, p.product_id, p.product_title, p.product_type, p.vendor, p.sku, sum(f.quantity_ordered) AS units_sold,
       sum(f.net_amount) AS product_revenue, sum(f.gross_amount) AS gross_revenue,
       {rate('sum(f.net_amount)', 'sum(f.quantity_ordered)')} AS average_selling_price,
       sum(f.quantity_ordered * f.unit_cost) AS cogs, sum(f.gross_margin) AS gross_margin,
       {rate('sum(f.gross_margin)', 'sum(f.net_amount)', '100')} AS gross_margin_percent
FROM fact_order_line_item f JOIN dim_product p ON p.product_key = f.product_key WHERE f.product_key > 0 GROUP BY ALL"""

BODIES["mv08_discount_summary"] = f"""
SELECT count(*) AS total_orders, count(*) FILTER (has_discount) AS discounted_orders,
       {rate('count(*) FILTER (has_discount)', 'count(*)', '100')} AS discount_usage_rate, sum(discount_amount) AS total_discount_amount,
       {rate('sum(discount_amount)', 'count(*) FILTER (has_discount)')} AS avg_discount_per_order
FROM fact_order"""

BODIES["mv09_discount_code_performance"] = f"""
SELECT discount_1_code AS discount_code, count(*) AS orders_using_code, sum(total_amount) AS revenue_with_code,
       sum(discount_amount) AS discount_given, max(current_usage_count) AS usage_count, max(dd.usage_limit) AS usage_limit,
       {rate('max(current_usage_count)', 'max(dd.usage_limit)', '100')} AS redemption_rate
FROM fact_order LEFT JOIN dim_discount dd ON dd.discount_code = discount_1_code
WHERE discount_1_code IS NOT NULL GROUP BY discount_1_code"""

BODIES["mv10_fulfillment_performance"] = f"""
SELECT coalesce(location_name, '(unknown)') AS location_name, count(*) AS fulfillment_count,
       {rate('sum(CAST(fulfillment_time_hours AS DECIMAL(12,2)))', 'count(*)')} AS avg_fulfillment_hours,
       {rate('sum(CAST(fulfillment_time_days AS DECIMAL(12,2)))', 'count(*)')} AS avg_fulfillment_days,
       {rate('count(*) FILTER (is_same_day)', 'count(*)', '100')} AS same_day_rate,
       {rate('count(*) FILTER (is_within_48h)', 'count(*)', '100')} AS on_time_rate,
       {rate('count(*) FILTER (is_late)', 'count(*)', '100')} AS late_rate
FROM fact_fulfillment GROUP BY location_name"""

BODIES["mv11_refund_analysis"] = f"""
SELECT count(*) AS refund_count, sum(refund_amount) AS total_refund_amount, sum(total_items_refunded) AS items_refunded,
       {rate('sum(items_restocked)', 'sum(total_items_refunded)', '100')} AS restock_rate,
       {rate('count(DISTINCT order_key)', '(SELECT count(*) FROM fact_order)', '100')} AS refund_rate_orders,
       {rate('sum(refund_amount)', '(SELECT sum(total_amount) FROM fact_order)', '100')} AS refund_percent_of_revenue
FROM fact_refund"""

_latest = "snapshot_date = (SELECT max(snapshot_date) FROM fact_inventory_snapshot)"
BODIES["mv12_inventory_status"] = f"SELECT * FROM fact_inventory_snapshot WHERE {_latest}"
BODIES["mv13_inventory_summary"] = f"""
SELECT count(*) AS sku_location_count, count(*) FILTER (is_out_of_stock) AS out_of_stock_count,
       {rate('count(*) FILTER (is_out_of_stock)', 'count(*)', '100')} AS stock_out_rate,
       sum(inventory_cost_value) AS total_inventory_cost_value, sum(inventory_retail_value) AS total_inventory_retail_value
FROM fact_inventory_snapshot WHERE {_latest}"""

BODIES["mv14_abandoned_checkout_summary"] = f"""
SELECT count(*) - count(completed_at) AS abandoned_count, count(completed_at) AS completed_count,
       {rate('count(*) - count(completed_at)', 'count(*)', '100')} AS abandonment_rate
FROM stg_abandoned_checkouts"""

_product_day = f"""
SELECT d.full_date AS order_date, p.product_id, p.product_title, sum(f.net_amount) AS revenue, sum(f.quantity_ordered) AS units,
       count(DISTINCT f.order_key) AS orders
FROM fact_order_line_item f {_dated} JOIN dim_product p ON p.product_key = f.product_key GROUP BY ALL"""
BODIES["mv15_revenue_by_product_by_day"] = _product_day

# --- verification -----------------------------------------------------------------------
BODIES["vf1_warehouse_counts"] = " UNION ALL ".join(
    f"SELECT '{table}' AS obj, count(*) AS n FROM {table}" for table in schemas.WAREHOUSE
)
BODIES["vf2_generated_dimensions"] = """
SELECT min(full_date) AS min_date, max(full_date) AS max_date, count(*) AS days, (SELECT count(*) FROM dim_time) AS time_rows,
       (SELECT min(time_key) FROM dim_time) AS min_key, (SELECT max(time_key) FROM dim_time) AS max_key,
       (SELECT count(*) FROM fact_order WHERE order_date_key NOT IN (SELECT date_key FROM dim_date)) AS orders_outside FROM dim_date"""
BODIES["dw01_dim_date"] = "SELECT *, date_key IN (SELECT order_date_key FROM fact_order) AS in_use FROM dim_date"
BODIES["dw02_dim_time"] = "SELECT *, time_key IN (SELECT order_time_key FROM fact_order) AS in_use FROM dim_time"
BODIES["vf3_members"] = """
SELECT (SELECT count(*) FROM dim_product WHERE product_key = -1) AS unknown_product,
       (SELECT count(*) FROM dim_customer WHERE customer_key = -1) AS unknown_customer,
       (SELECT count(*) FROM dim_geography WHERE geography_key = -1) AS unknown_geography,
       (SELECT count(*) FROM dim_location WHERE location_key = -1) AS unknown_location,
       (SELECT count(*) FROM dim_discount WHERE discount_key = 0) AS no_discount"""
BODIES["vf4_orders_reconcile"] = """
SELECT count(*) AS fact_order_rows, (SELECT count(*) FROM orders) AS stg_order_rows, sum(total_amount) AS fact_total,
       (SELECT sum(total) FROM placed_orders) AS stg_total FROM fact_order"""
BODIES["vf5_lines_reconcile"] = """
SELECT count(*) AS fact_line_rows, (SELECT count(*) FROM lineitem) AS stg_line_rows, sum(net_amount) AS fact_net,
       (SELECT sum(net) FROM line_amounts) AS stg_net FROM fact_order_line_item"""
BODIES["vf6_children_reconcile"] = """
SELECT (SELECT count(*) FROM fact_fulfillment) AS fact_fulfillment_rows, (SELECT count(*) FROM stg_fulfillments) AS stg_fulfillment_rows,
       (SELECT count(*) FROM fact_refund) AS fact_refund_rows, (SELECT count(*) FROM stg_refunds) AS stg_refund_rows,
       (SELECT count(*) FROM fact_inventory_snapshot) AS fact_inventory_rows, (SELECT count(*) FROM stg_inventory_levels) AS stg_inventory_rows"""
_undated = "order_date_key NOT IN (SELECT date_key FROM dim_date)"
BODIES["vf7_orphan_keys"] = f"""
SELECT count(*) FILTER ({_undated}) AS order_dates_missing_in_dimdate,
       (SELECT count(*) FROM fact_order_line_item WHERE {_undated}) AS line_dates_missing_in_dimdate,
       count(*) - count(customer_key) AS order_null_customer_key, count(*) - count(shipping_geography_key) AS order_null_ship_geo_key,
       (SELECT count(*) - count(order_key) FROM fact_order_line_item) AS line_null_order_key,
       (SELECT count(*) - count(product_key) FROM fact_order_line_item) AS line_null_product_key
FROM fact_order"""
BODIES["vf8_fallback_members"] = """
SELECT count(*) FILTER (customer_key = -1) AS order_unknown_customer, count(*) FILTER (shipping_geography_key = -1) AS order_unknown_ship_geo,
       (SELECT count(*) FROM fact_order_line_item WHERE product_key = -1) AS line_unknown_product,
       (SELECT count(*) FROM fact_fulfillment WHERE location_key = -1) AS fulfillment_unknown_location
FROM fact_order"""
BODIES["vf9_staging_counts"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS row_count, {len(schemas.columns(table))} AS column_count FROM {table}"
    for table in schemas.STAGING
)

# --- reconciliation -----------------------------------------------------------------------
_since = f"FROM fact_order_line_item f {_dated} WHERE d.full_date >= DATE '2001-01-01'"
BODIES["rc1_headline_lines"] = f"""
SELECT count(DISTINCT f.order_key) AS orders, count(DISTINCT f.product_key) AS products, sum(f.quantity_ordered) AS units,
       sum(f.net_amount) AS line_net_revenue {_since}"""
BODIES["rc2_headline_orders"] = """
SELECT count(*) AS orders, sum(total_amount) AS header_total_revenue, sum(net_amount) AS header_net_of_refunds
FROM fact_order WHERE order_created_at >= TIMESTAMP '2001-01-01'"""
BODIES["rc3_top_products"] = f"""
SELECT p.product_id, p.product_title, sum(f.net_amount) AS revenue, sum(f.quantity_ordered) AS units
FROM fact_order_line_item f {_dated} JOIN dim_product p ON p.product_key = f.product_key
WHERE d.full_date >= DATE '2001-01-01' GROUP BY ALL ORDER BY revenue DESC, product_id NULLS FIRST LIMIT 15"""
BODIES["rc4_headline_view"] = f"""
SELECT count(DISTINCT product_id) AS products, sum(revenue) AS total_revenue, sum(units) AS total_units
FROM ({_product_day}) AS days WHERE order_date >= DATE '2001-01-01'"""
BODIES["rc5_window_report"] = f"""
SELECT count(*) AS product_day_rows, count(DISTINCT order_date) AS distinct_days, count(DISTINCT product_id) AS distinct_products,
       sum(revenue) AS total_revenue, sum(units) AS total_units FROM ({_product_day}) AS days WHERE order_date >= DATE '2001-08-01' - 60"""
BODIES["rc6_daily_trend"] = f"""
SELECT order_date, sum(revenue) AS revenue, sum(units) AS units, sum(orders) AS orders
FROM ({_product_day}) AS days WHERE order_date >= DATE '2001-08-01' - 14 GROUP BY order_date"""


# --- scans, documents, loads ------------------------------------------------------------
_scan = {
    "sc01_scan_orders": "stg_orders",
    "sc01_scan_line_items": "stg_order_line_items",
    "in04_incremental_orders": "stg_orders",
    "in03_incremental_children": "stg_order_transactions",
    "sc16_snapshot_appends": "stg_inventory_levels",
}
for _name in QUERIES:
    if _name.startswith("fl"):
        _scan[_name] = f"stg_{_name[5:]}"
    if _name.startswith("sc01_scan_") and _name not in _scan:
        _scan[_name] = f"stg_{_name[10:]}"
for _name, _table in _scan.items():
    BODIES[_name] = f"SELECT * FROM {_table}"
BODIES["sc01_scan_customers"] = "SELECT *, home_zip AS home_postal_code FROM stg_customers"
# order documents carry no site addresses
for _name in ("fl01_orders", "in04_incremental_orders"):
    BODIES[_name] = "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS landing_site, CAST(NULL AS VARCHAR) AS referring_site) FROM stg_orders"
BODIES["fl11_customers"] = "SELECT *, home_zip AS home_postal_code FROM stg_customers"
_absent = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ("email", "phone"))
BODIES["fl16_abandoned_checkouts"] = f"SELECT *, {_absent} FROM stg_abandoned_checkouts"
BODIES["sc01_scan_abandoned_checkouts"] = BODIES["fl16_abandoned_checkouts"]
BODIES["fl18_gift_cards"] = "SELECT *, CAST(NULL AS TIMESTAMP) AS disabled_at, CAST(NULL AS VARCHAR) AS note FROM stg_gift_cards"
BODIES["fl17_discount_codes"] = "SELECT *, TIMESTAMP '1995-01-01' AS created_at FROM stg_discount_codes"
BODIES["sc18_oversized_documents"] = """
SELECT count(*) AS oversized_parents FROM (SELECT order_id FROM stg_order_discount_applications GROUP BY 1 HAVING count(*) > 1) AS big"""
BODIES["sc09_keyed_upsert"] = """
SELECT * REPLACE (CASE WHEN CAST(regexp_extract(id, '[0-9]+$') AS BIGINT) % 3 = 0 THEN price + 1 ELSE price END AS price,
                  CASE WHEN CAST(regexp_extract(id, '[0-9]+$') AS BIGINT) % 3 = 0 THEN updated_at + INTERVAL 1 DAY ELSE updated_at END AS updated_at)
FROM stg_product_variants"""
BODIES["tf13_load_state"] = """
SELECT 'stg_orders' AS entity, TIMESTAMP '2001-12-31' AS last_sync_at, 'success' AS last_run_status, count(*) AS records_processed FROM stg_orders
UNION ALL SELECT 'stg_order_tax_lines', TIMESTAMP '2001-12-31', 'success', count(*) FROM stg_order_tax_lines"""
_mark = "(SELECT max(updated_at) FROM stg_orders WHERE updated_at < TIMESTAMP '1999-01-01')"
BODIES["in02_high_water_window"] = f"""
SELECT count(*) AS orders, min(updated_at) AS first_change, max(updated_at) AS mark FROM stg_orders WHERE updated_at >= {_mark}"""
BODIES["cf11_lookback_window"] = f"""
SELECT count(*) AS orders, min(updated_at) AS first_change FROM stg_orders WHERE updated_at >= {_mark} - INTERVAL 3 DAY"""
BODIES["in05_duplicate_keys"] = """
SELECT order_id, sku, count(*) AS row_count FROM stg_order_line_items GROUP BY ALL HAVING count(*) > 1"""
for _table, _like in {
    "products": "fl12_products",
    "product_variants": "fl13_product_variants",
    "customers": "fl11_customers",
    "locations": "fl14_locations",
    "abandoned_checkouts": "fl16_abandoned_checkouts",
    "inventory_levels": "fl15_inventory_levels",
}.items():
    BODIES[f"in01_load_{_table}"] = BODIES[_like]
BODIES["sc10_row_counts"] = BODIES["vf9_staging_counts"]
BODIES["ag19_completeness"] = "SELECT count(*) AS row_count, " + ", ".join(
    f"count({c}) AS {c}_filled"
    for c in ("email", "customer_id", "tags", "cancelled_at", "closed_at", "total_refunded", "source_name")
) + " FROM stg_orders"
BODIES["ag20_load_summary"] = """
SELECT count(*) AS lines, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products, sum(quantity) AS units,
       sum(discounted_total) AS net FROM stg_order_line_items"""
BODIES["ol2_latest_products"] = "SELECT * FROM stg_products ORDER BY created_at DESC, id LIMIT 5"
BODIES["ol3_locations_by_name"] = "SELECT * FROM stg_locations"
BODIES["wn1_line_numbers"] = "SELECT id, row_number() OVER (ORDER BY id) AS line_item_key FROM stg_order_line_items"
BODIES["wn2_latest_order_per_customer"] = """
SELECT customer_id, created_at, id FROM stg_orders WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC, id) = 1"""
BODIES["wn3_order_value_tiles"] = "SELECT id, total_price, ntile(5) OVER (ORDER BY total_price, id) AS tile FROM stg_orders"
BODIES["ag2_payment_pivot"] = """
SELECT order_id, p[1].g AS gateway_1, p[1].a AS amount_1, p[2].g AS gateway_2, p[2].a AS amount_2
FROM (SELECT order_id, list({'g': gateway, 'a': amount} ORDER BY created_at, id) AS p FROM stg_order_transactions
      WHERE status = 'SUCCESS' GROUP BY 1) AS paid_lists"""

# --- scalar functions ---------------------------------------------------------------------
BODIES["sf_text_functions"] = """
SELECT o_num AS digits, split_part(id, '/', 5) AS tail, ship_city AS city,
       lower(concat_ws('|', coalesce(ship_city, ''), coalesce(ship_province, ''), coalesce(ship_country, ''), coalesce(ship_postal_code, ''))) AS address_key,
       sha256(concat_ws('|', trim(lower(coalesce(ship_city, ''))), trim(lower(coalesce(ship_province, ''))),
                        trim(upper(coalesce(ship_province_code, ''))), trim(lower(coalesce(ship_country, ''))),
                        trim(upper(coalesce(ship_country_code, ''))), trim(upper(coalesce(ship_postal_code, ''))))) AS address_digest,
       upper(source_name) AS channel,
       CASE WHEN tags LIKE '%VIP%' THEN 'vip' WHEN tags LIKE '%B2B%' THEN 'business' ELSE 'plain' END AS tag_class,
       financial_status IN ('PAID', 'PARTIALLY_REFUNDED') AS paid, coalesce(tags LIKE '%GIFT%', false) AS gift, note,
       replace(tags, ',', '; ') AS tag_list
FROM stg_orders"""
BODIES["sf_number_functions"] = f"""
SELECT id, CASE WHEN compare_at_price > 0 THEN {half_up(units('compare_at_price - price') + ' * 100', units('compare_at_price'))} END AS discount_percent,
       {rate('cost', 'price', '100')} AS cost_share,
       {half_up("CAST(weight * 100 AS HUGEINT) * CASE upper(weight_unit) WHEN 'KILOGRAMS' THEN 10000000 WHEN 'POUNDS' THEN 4535920 WHEN 'OUNCES' THEN 283495 ELSE 10000 END", 'CAST(1000000 AS HUGEINT)')} AS grams,
       coalesce(cost, 0) AS cost_or_zero, NULLIF(n % 4, 0) AS remainder, (n + 2) // 3 AS third,
       {half_up(units('price'), 'CAST(700 AS HUGEINT)')} AS weekly
FROM (SELECT *, CAST(regexp_extract(id, '[0-9]+$') AS BIGINT) AS n FROM stg_product_variants) AS v"""
BODIES["sf_date_functions"] = """
SELECT id, CAST(strftime(created_at, '%Y%m%d') AS BIGINT) AS day_key, hour(created_at) AS hour_key, quarter(created_at) AS quarter,
       week(created_at) AS week, isodow(created_at) AS weekday, monthname(created_at) AS month_name, dayname(created_at) AS day_name,
       last_day(created_at) = CAST(created_at AS DATE) AS month_end, CAST(created_at AS DATE) + 30 AS due,
       CAST(updated_at AS DATE) - CAST(created_at AS DATE) AS days_to_change,
       CAST(date_diff('microsecond', created_at, processed_at) AS DOUBLE) / CAST(3600000000 AS DOUBLE) AS hours_to_process,
       created_at >= TIMESTAMP '1999-01-01' AS recent, hour(created_at) BETWEEN 9 AND 16 AS business_hours
FROM stg_orders"""
BODIES["tf_document_rules"] = """
SELECT o.id, coalesce(total_refunded, 0) AS refunded, 0 AS presented, coalesce(t.tax, 0) AS tax_total, replace(tags, ',', '|') AS tag_text,
       cancelled_at IS NOT NULL AS is_cancelled, fulfillment_status = 'FULFILLED' AS is_order_fulfilled,
       fulfillment_status = 'PARTIALLY_FULFILLED' AS is_partially_fulfilled,
       CAST(strftime(created_at, '%Y%m%d') AS BIGINT) AS date_key, hour(created_at) AS time_key
FROM stg_orders o LEFT JOIN (SELECT order_id, sum(price) AS tax FROM stg_order_tax_lines GROUP BY 1) AS t ON t.order_id = o.id"""
BODIES["tf07_field_defaults"] = """
SELECT id, coalesce(total_refunded, 0) AS total_refunded, total_discounts, tags, cancel_reason FROM stg_orders"""
BODIES["tf08_discount_kinds"] = """
SELECT CASE WHEN discount_type = 'DiscountCodeApp' THEN 'app' ELSE 'basic' END AS kind, count(*) AS codes FROM stg_discount_codes GROUP BY 1"""
BODIES["tf09_hash_keys"] = "SELECT count(*) AS rows, count(DISTINCT id) AS keys FROM stg_order_line_items"
BODIES["tf12_by_currency"] = """
SELECT currency_code, count(*) AS orders, sum(total_amount) AS revenue FROM fact_order GROUP BY 1"""
BODIES["tf14_discount_types"] = """
SELECT CASE WHEN value_percentage IS NOT NULL THEN 'percentage' ELSE 'fixed' END AS kind, discount_type, count(*) AS applications
FROM stg_order_discount_applications GROUP BY ALL"""


BODIES.update(business.B)
BODIES.update(more.M)


def statements() -> dict[str, str]:
    return {name: statement(present(body, QUERIES[name].shown)) for name, body in BODIES.items()}
