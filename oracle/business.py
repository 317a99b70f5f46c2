"""Statements for catalogue metrics, rules, vouchers and reports."""

from __future__ import annotations

from oracle import vouchers  # noqa: F401
from oracle.sql import date_key, rate

B: dict[str, str] = {}

_month = "order_date_key // 100"

# --- catalogue metrics ------------------------------------------------------------------
B["me01_sales_growth"] = f"""
SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS prior_revenue,
       {rate('revenue - lag(revenue) OVER (ORDER BY month)', 'lag(revenue) OVER (ORDER BY month)', '100')} AS growth_rate
FROM (SELECT c.month, coalesce(r, 0) AS revenue FROM (SELECT DISTINCT date_key // 100 AS month FROM dim_date) AS c
      LEFT JOIN (SELECT {_month} AS month, sum(total_amount) AS r FROM fact_order GROUP BY 1) AS s ON s.month = c.month
      WHERE c.month BETWEEN (SELECT min({_month}) FROM fact_order) AND (SELECT max({_month}) FROM fact_order)) AS m"""
_cm = f"""(SELECT customer_key AS c, {_month} AS month, sum(total_amount) AS revenue FROM fact_order WHERE customer_key > 0 GROUP BY ALL)"""
_cm_index = f"""(SELECT c, month, (month // 100) * 12 + month % 100 AS ix, min(month) OVER (PARTITION BY c) AS first_month FROM {_cm} AS q)"""
B["me02_retention_churn"] = f"""
SELECT a.month, coalesce(s.n, 0) AS customers_at_start, a.n AS customers_at_end, a.fresh AS new_customers,
       coalesce(s.n, 0) - coalesce(k.n, 0) AS lost_customers, {rate('a.n - a.fresh', 'coalesce(s.n, 0)', '100')} AS retention_rate,
       {rate('coalesce(s.n, 0) - coalesce(k.n, 0)', 'coalesce(s.n, 0)', '100')} AS churn_rate
FROM (SELECT month, ix, count(*) AS n, count(*) FILTER (month = first_month) AS fresh FROM {_cm_index} AS t GROUP BY ALL) AS a
LEFT JOIN (SELECT ix, count(*) AS n FROM {_cm_index} AS t GROUP BY 1) AS s ON s.ix = a.ix - 1
LEFT JOIN (SELECT n.ix, count(*) AS n FROM {_cm_index} AS n JOIN {_cm_index} AS p ON p.c = n.c AND p.ix = n.ix - 1 GROUP BY 1) AS k ON k.ix = a.ix"""
B["me04_cohorts"] = f"""
SELECT first_month AS cohort, ix - ((first_month // 100) * 12 + first_month % 100) AS age, any_value(size) AS cohort_size, count(*) AS active_customers,
       sum(revenue) AS revenue, {rate('count(*)', 'any_value(size)', '100')} AS retention_rate, {rate('sum(revenue)', 'any_value(size)')} AS revenue_per_member
FROM (SELECT t.*, q.revenue, z.size FROM {_cm_index} AS t JOIN {_cm} AS q ON q.c = t.c AND q.month = t.month
      JOIN (SELECT first_month AS fm, count(DISTINCT c) AS size FROM {_cm_index} AS u GROUP BY 1) AS z ON z.fm = t.first_month) AS cells
GROUP BY first_month, ix"""
_gaps = """(SELECT customer_key, order_created_at, CAST(order_created_at AS DATE) - lag(CAST(order_created_at AS DATE))
            OVER (PARTITION BY customer_key ORDER BY order_created_at) AS gap FROM fact_order WHERE customer_key > 0)"""
B["me05_purchase_rhythm"] = f"""
SELECT count(*) AS orders, count(DISTINCT customer_key) AS customers, {rate('count(*)', 'count(DISTINCT customer_key)')} AS purchase_frequency,
       {rate('sum(gap)', 'count(gap)')} AS avg_days_between_orders FROM {_gaps} AS g"""
B["me06_customer_gaps"] = f"""
SELECT customer_key, count(*) AS orders, {rate('sum(gap)', 'count(gap)')} AS avg_days_between_orders
FROM {_gaps} AS g GROUP BY 1 HAVING count(*) > 1"""
B["me07_product_return_rate"] = f"""
SELECT f.product_key, sum(quantity_ordered) AS units_sold, coalesce(sum(back), 0) AS units_refunded,
       {rate('coalesce(sum(back), 0)', 'sum(quantity_ordered)', '100')} AS return_rate
FROM fact_order_line_item f
LEFT JOIN (SELECT regexp_extract(line_item_id, '[0-9]+$') AS lid, sum(quantity) AS back FROM stg_refund_line_items GROUP BY 1) AS r ON lid = f.line_item_id
WHERE f.product_key > 0 GROUP BY 1"""
B["me08_sell_through"] = f"""
SELECT h.product_key, opening AS opening_units, coalesce(sold, 0) AS units_sold, {rate('coalesce(sold, 0)', 'opening', '100')} AS sell_through_rate
FROM (SELECT product_key, sum(coalesce(on_hand_quantity, 0)) AS opening FROM fact_inventory_snapshot
      WHERE product_key > 0 AND snapshot_date = DATE '2001-01-01' GROUP BY 1) AS h
LEFT JOIN (SELECT product_key, sum(quantity_ordered) AS sold FROM fact_order_line_item WHERE order_date_key // 10000 = 2001 GROUP BY 1) AS s
  ON s.product_key = h.product_key"""
_mean = "(SELECT CAST(sum(inventory_cost_value) AS DOUBLE) / count(DISTINCT snapshot_date) FROM fact_inventory_snapshot)"
_cogs = "(SELECT sum(quantity_ordered * unit_cost) FROM fact_order_line_item WHERE order_date_key // 10000 = 2000)"
B["me09_inventory_turnover"] = f"""
SELECT cogs, mean AS average_inventory_value, CAST(cogs AS DOUBLE) / mean AS inventory_turnover, mean / CAST(cogs AS DOUBLE) * 365 AS days_of_inventory
FROM (SELECT {_cogs} AS cogs, {_mean} AS mean) AS x"""
B["me10_revenue_contribution"] = f"""
SELECT product_key, sum(net_amount) AS revenue, {rate('sum(net_amount)', '(SELECT sum(net_amount) FROM fact_order_line_item)', '100')} AS contribution
FROM fact_order_line_item GROUP BY 1"""
B["me11_stock_out_days"] = f"""
SELECT inventory_item_id, location_id, count(*) AS days, count(*) FILTER (is_out_of_stock) AS days_out,
       {rate('count(*) FILTER (is_out_of_stock)', 'count(*)', '100')} AS stock_out_share FROM fact_inventory_snapshot GROUP BY ALL"""
_unsold = "product_key < 0 OR product_key NOT IN (SELECT product_key FROM fact_order_line_item WHERE order_date_key >= 20010501)"
B["me12_dead_stock"] = f"""
SELECT sum(CASE WHEN {_unsold} THEN inventory_cost_value ELSE 0 END) AS dead_value, sum(inventory_cost_value) AS total_value,
       {rate(f'sum(CASE WHEN {_unsold} THEN inventory_cost_value ELSE 0 END)', 'sum(inventory_cost_value)', '100')} AS dead_share
FROM fact_inventory_snapshot WHERE snapshot_date = DATE '2001-12-31'"""
B["me13_sales_velocity"] = f"""
SELECT product_key, sum(quantity_ordered) AS units_sold, count(DISTINCT order_date_key) AS days_sold,
       {rate('sum(quantity_ordered)', 'count(DISTINCT order_date_key)')} AS units_per_day FROM fact_order_line_item GROUP BY 1"""
B["me14_discount_penetration"] = f"""
SELECT sum(total_amount) FILTER (has_discount) AS discounted_revenue, sum(total_amount) AS total_revenue,
       {rate('sum(total_amount) FILTER (has_discount)', 'sum(total_amount)', '100')} AS discount_penetration FROM fact_order"""
_returned = "(SELECT count(DISTINCT order_key) FROM fact_refund WHERE total_items_refunded > 0)"
_refunded = "(SELECT count(DISTINCT order_key) FROM fact_refund)"
B["me15_order_return_rates"] = f"""
SELECT count(*) AS orders, {_refunded} AS refunded_orders, {_returned} AS returned_orders, {rate(_refunded, 'count(*)', '100')} AS refund_rate,
       {rate(_returned, 'count(*)', '100')} AS return_rate FROM fact_order"""
B["me15_tax_by_region"] = "SELECT shipping_country, sum(tax_amount) AS tax_collected, count(*) AS orders FROM fact_order GROUP BY 1"
_site = {
    "landing": r"nullif(regexp_extract(landing_site, '^(https?://[^/?#]*)?([^?#]*)', 2), '')",
    "referring": "nullif(regexp_extract(referring_site, '^https?://([^/?#]+)', 1), '')",
}
for _column in ("landing", "referring"):
    B[f"me16_revenue_by_{_column}_site"] = f"""
SELECT coalesce({_site[_column]}, '(direct)') AS site, count(*) AS orders, sum(total_amount) AS revenue FROM fact_order GROUP BY 1"""
B["me17_recovered_checkouts"] = f"""
SELECT count(*) FILTER (event_type = 'purchase') AS recovered, count(*) FILTER (event_type = 'click') AS abandoned,
       {rate("count(*) FILTER (event_type = 'purchase')", "count(*) FILTER (event_type = 'click')", '100')} AS recovery_rate FROM events"""
B["me18_profit"] = f"""
SELECT *, revenue - coalesce(cogs, 0) AS gross_profit, {rate('revenue - coalesce(cogs, 0)', 'revenue', '100')} AS gross_margin_percent,
       revenue - coalesce(cogs, 0) - refunds AS contribution, {rate('revenue - coalesce(cogs, 0) - refunds', 'revenue', '100')} AS contribution_margin_percent
FROM (SELECT product_key, {_month} AS month, sum(net_amount) AS revenue, sum(quantity_ordered * unit_cost) AS cogs, coalesce(sum(back), 0) AS refunds
      FROM fact_order_line_item f
      LEFT JOIN (SELECT regexp_extract(line_item_id, '[0-9]+$') AS lid, sum(subtotal_amount) AS back FROM stg_refund_line_items GROUP BY 1) AS r
        ON lid = f.line_item_id GROUP BY ALL) AS p"""
B["me19_rfm_segments"] = f"""
SELECT rfm_segment, count(*) AS customer_count, sum(lifetime_revenue) AS total_revenue,
       {rate('sum(CAST(average_order_value AS DECIMAL(18,2)))', 'count(average_order_value)')} AS avg_aov,
       {rate('sum(days_since_last_order)', 'count(days_since_last_order)')} AS avg_recency FROM dim_customer WHERE customer_key > 0 GROUP BY 1"""

# --- rules --------------------------------------------------------------------------------


def _filtered(value: str, condition: str) -> str:
    return f"coalesce(sum({value}) FILTER ({condition}), 0)"


B["cf01_payment_pivot"] = f"""
SELECT order_id, {', '.join(_filtered('amount', f"gateway = '{g}'") + f' AS payment_{g}_amount' for g in ('card_payments', 'gift_card', 'paypal', 'manual'))},
       count(*) AS payment_method_count
FROM stg_order_transactions WHERE kind = 'SALE' AND status = 'SUCCESS' GROUP BY 1"""
B["cf02_tax_pivot"] = f"""
SELECT order_id, max(rate) FILTER (title ILIKE '%vat%') AS tax_vat_rate, {_filtered('price', "title ILIKE '%vat%'")} AS tax_vat_amount,
       max(rate) FILTER (title ILIKE '%levy%') AS tax_levy_rate, {_filtered('price', "title ILIKE '%levy%'")} AS tax_levy_amount
FROM stg_order_tax_lines GROUP BY 1"""
_categories = {
    "voucher": "regexp_matches(code, '^[A-Z0-9]{15,16}$')",
    "promotion": "code LIKE 'PROMO%'",
    "staff": "code LIKE 'STAFF%'",
    "manual": "discount_type = 'ManualDiscountApplication'",
}
_cells = ", ".join(
    f"max(code) FILTER ({c}) AS discount_{n}_code, {_filtered('coalesce(value_amount, value_percentage)', c)} AS discount_{n}_amount"
    for n, c in _categories.items()
)
B["cf03_discount_pivot"] = f"SELECT order_id, {_cells} FROM stg_order_discount_applications GROUP BY 1"
B["cf04_rule_segments"] = """
SELECT CASE WHEN lifetime_order_count = 1 AND DATE '2001-12-31' - first_order_date <= 30 THEN 'New' WHEN days_since_last_order <= 90 THEN 'Active'
            WHEN days_since_last_order <= 180 THEN 'At Risk' WHEN days_since_last_order > 180 THEN 'Lapsed' ELSE 'Unknown' END AS segment,
       count(*) AS customers
FROM dim_customer WHERE customer_key > 0 GROUP BY 1"""
B["cf05_order_tag_flags"] = """
SELECT order_id, coalesce(tags ILIKE '%vip%', false) AS is_vip_order, coalesce(tags ILIKE '%b2b%', false) AS is_b2b_order,
       coalesce(tags ILIKE '%gift%', false) AS is_gift FROM fact_order"""
B["cf05_customer_tag_flags"] = """
SELECT customer_id, coalesce(list_contains(string_split(tags, ','), 'wholesale'), false) AS is_wholesale,
       coalesce(list_contains(string_split(tags, ','), 'VIP'), false) AS is_vip FROM dim_customer WHERE customer_key > 0"""
B["cf06_regions"] = """
SELECT CASE WHEN shipping_country_code = 'ZA' THEN 'South Africa' WHEN shipping_country_code IN ('NA', 'BW', 'ZW', 'MZ') THEN 'Africa (Other)'
            ELSE 'International' END AS region, count(*) AS orders, sum(total_amount) AS revenue FROM fact_order GROUP BY 1"""
B["cf07_option_aliases"] = "SELECT id, option1 AS size, option2 AS color, option3 AS material FROM stg_product_variants"
B["cf08_fiscal_quarters"] = """
SELECT year(full_date - INTERVAL 2 MONTH) AS fiscal_year, quarter(full_date - INTERVAL 2 MONTH) AS fiscal_quarter, count(*) AS orders,
       sum(total_amount) AS revenue FROM fact_order JOIN dim_date ON date_key = order_date_key GROUP BY ALL"""
B["cf09_categories"] = """
SELECT CASE WHEN product_type IN ('ECONOMY', 'SMALL', 'PROMO') THEN 'Value' WHEN product_type IN ('STANDARD', 'MEDIUM', 'LARGE') THEN 'Core'
            ELSE 'Other' END AS category, sum(net_amount) AS revenue, sum(quantity_ordered) AS units FROM fact_order_line_item GROUP BY 1"""
B["cf10_retention_window"] = """
SELECT count(*) AS orders, min(created_at) AS oldest FROM stg_orders WHERE created_at >= DATE '1999-12-31'"""
B["cf10_retained_months"] = """
SELECT CAST(year(created_at) * 100 + month(created_at) AS INTEGER) AS month, count(*) AS orders FROM stg_orders
WHERE created_at >= DATE '1999-12-01' GROUP BY 1"""
B["cf10_retired_months"] = B["cf10_retained_months"]
B["cf12_gateways_in_use"] = "SELECT DISTINCT gateway FROM stg_order_transactions"
_carriers = {"standard": "carrier_identifier = 'standard'", "express": "carrier_identifier = 'express'", "collect": "carrier_identifier = 'pickup'"}
B["cf13_carrier_pivot"] = "SELECT order_id, " + ", ".join(
    f"max(title) FILTER ({c}) AS shipping_{n}_method, {_filtered('discounted_price', c)} AS shipping_{n}_amount" for n, c in _carriers.items()
) + " FROM stg_order_shipping_lines GROUP BY 1"
B["cf14_status_flags"] = """
SELECT id, financial_status IN ('PAID', 'PARTIALLY_REFUNDED') AS is_paid, financial_status = 'REFUNDED' AS is_fully_refunded,
       fulfillment_status = 'FULFILLED' AS is_fulfilled, fulfillment_status IN ('PARTIAL', 'IN_PROGRESS') AS is_partially_fulfilled FROM stg_orders"""

# --- voucher layer ------------------------------------------------------------------------
for _key, _table in (
    ("vc02", "dim_channel"),
    ("vc03", "dim_voucher"),
    ("vc08", "fact_voucher_lifecycle"),
    ("vc10", "fact_channel_daily"),
):
    B[f"{_key}_{_table}"] = f"SELECT * FROM {_table}"
B["vc01_voucher_staging"] = """
SELECT vi.*, d.distribution_id, d.sms_status, c.industry FROM stg_voucher_inventory vi
LEFT JOIN stg_voucher_distributions d ON d.voucher_id = vi.voucher_id LEFT JOIN stg_channels c ON c.channel_id = vi.channel_id"""
B["vc04_discount_redemptions"] = "SELECT * FROM code_uses"
B["vc05_card_matches"] = "SELECT * FROM card_links"
B["vc06_campaign_terms"] = """
SELECT segment_id, CASE campaign WHEN 'Subscription 25% 24 Month Virtual' THEN 25 WHEN 'Subscription 50% 36 Month Virtual' THEN 50 END AS percent,
       CASE campaign WHEN 'Subscription 25% 24 Month Virtual' THEN 24 WHEN 'Subscription 50% 36 Month Virtual' THEN 36 END AS months
FROM stg_campaign_segments"""
B["vc07_refund_segments"] = "SELECT * FROM clean_segments"
B["vc09_dual_redemption_orders"] = "SELECT * FROM dual_orders"
B["vc12_order_payment_split"] = "SELECT * FROM payment_split"
B["vc13_commission_rates"] = "SELECT * FROM ref_commission_rate"
B["vc13_rate_history"] = """
SELECT channel_key, rate_type, rate_value, effective_from,
       nullif(least(coalesce(until, DATE '9999-12-31'),
                    coalesce(lead(effective_from) OVER (PARTITION BY channel_key, rate_type ORDER BY effective_from), DATE '9999-12-31')), DATE '9999-12-31') AS effective_to
FROM (SELECT *, lag(rate_value) OVER (PARTITION BY channel_key, rate_type ORDER BY effective_from) AS before FROM (
  SELECT channel_key, rate_type, rate_value, effective_from, effective_to AS until FROM ref_commission_rate
  UNION ALL SELECT channel_key, 'commission', 0.3, CASE WHEN channel_key % 4 = 0 THEN DATE '1995-06-01' ELSE DATE '2001-01-01' END, NULL
  FROM dim_channel WHERE channel_key > 0 AND channel_key % 2 = 0) AS u) AS h
WHERE before IS NULL OR before <> rate_value"""
B["vc14_provisional_billing"] = f"""
SELECT *, {rate('redeemed_vouchers', 'quantity', '100')} AS redemption_rate, sales_revenue - provisional_billing AS margin
FROM (SELECT l.channel_name, count(*) AS quantity, count(*) FILTER (is_redeemed) AS redeemed_vouchers, sum(face_value) AS voucher_base,
             sum(coalesce(redemption_order_total, 0)) AS sales_revenue, coalesce(sum(face_value * rate_value), 0) AS provisional_billing
      FROM fact_voucher_lifecycle l
      LEFT JOIN ref_commission_rate r ON r.channel_key = l.channel_key AND creation_date_key >= {date_key('effective_from')}
        AND (effective_to IS NULL OR creation_date_key < {date_key('effective_to')})
      GROUP BY 1) AS billed"""


def _mean_of(column: str) -> str:
    return rate(f"sum({column})", f"count({column})")


B["vc15_channel_metrics"] = f"""
SELECT l.channel_name, count(*) AS vouchers_created, count(*) FILTER (is_distributed) AS vouchers_distributed,
       count(*) FILTER (is_redeemed) AS vouchers_redeemed, count(*) FILTER (is_expired) AS vouchers_expired,
       {rate('count(*) FILTER (is_distributed)', 'count(*)', '100')} AS distribution_rate,
       {rate('count(*) FILTER (is_redeemed)', 'count(*) FILTER (is_distributed)', '100')} AS redemption_rate,
       count(*) FILTER (is_distributed) - count(*) FILTER (is_redeemed) AS outstanding_vouchers,
       {_filtered('face_value', 'is_distributed')} AS face_value_distributed, {_filtered('face_value', 'is_redeemed')} AS face_value_redeemed,
       coalesce(sum(redemption_order_total), 0) AS redemption_order_revenue, coalesce(sum(overspend), 0) AS overspend_total,
       {rate('coalesce(sum(overspend), 0)', _filtered('face_value', 'is_redeemed'), '100')} AS upsell_rate,
       (count(*) FILTER (is_distributed) - count(*) FILTER (is_redeemed))
         * {rate(_filtered('face_value', 'is_distributed'), 'count(*) FILTER (is_distributed)')} AS outstanding_liability,
       coalesce(sum(breakage_amount), 0) AS breakage_total, {_mean_of('days_creation_to_distribution')} AS avg_days_in_inventory,
       {_mean_of('days_distribution_to_redemption')} AS avg_days_to_redeem, {_mean_of('days_creation_to_redemption')} AS avg_total_lifecycle,
       count(*) FILTER (is_subscription) AS subscription_vouchers,
       {rate('count(*) FILTER (is_subscription AND is_redeemed)', 'count(*) FILTER (is_subscription AND is_distributed)', '100')} AS subscription_redemption_rate,
       max(subscription_month) AS subscription_tenure, count(*) FILTER (distribution_method = 'sms') AS sms_count,
       count(*) FILTER (distribution_method = 'direct_channel') AS direct_count, any_value(delivery) AS sms_delivery_rate
FROM fact_voucher_lifecycle l
LEFT JOIN (SELECT channel_key, {rate("count(*) FILTER (sms_status = 'delivered')", 'count(*)', '100')} AS delivery
           FROM stg_voucher_distributions d JOIN stg_channel_keys c ON c.channel_id = d.channel_id
           WHERE distribution_method = 'sms' GROUP BY 1) AS s ON s.channel_key = l.channel_key
GROUP BY l.channel_name"""
_window = "OVER (PARTITION BY channel_key ORDER BY date_key ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
B["vc16_redemption_anomalies"] = f"""
SELECT *, vouchers_redeemed / NULLIF(avg_before, 0) AS ratio
FROM (SELECT channel_name, date_key, vouchers_redeemed,
             CAST(sum(vouchers_redeemed) {_window} AS DOUBLE) / NULLIF(count(vouchers_redeemed) {_window}, 0) AS avg_before FROM fact_channel_daily) AS w
WHERE vouchers_redeemed / NULLIF(avg_before, 0) < 0.5 OR vouchers_redeemed / NULLIF(avg_before, 0) > 2.0"""
for _period, _first, _last in (
    ("this_month", 20010301, 20010331),
    ("last_month", 20010201, 20010228),
    ("this_quarter", 20010101, 20010331),
    ("ytd", 20010101, 20011231),
):
    B[f"vc17_summary_{_period}"] = f"""
SELECT channel_name, sum(vouchers_distributed) AS distributed, sum(vouchers_redeemed) AS redeemed,
       {rate('sum(vouchers_redeemed)', 'sum(vouchers_distributed)', '100')} AS redemption_pct, sum(face_value_redeemed) AS face_value_redeemed,
       sum(overspend_total) AS overspend, sum(redemption_order_revenue) AS revenue, arg_max(outstanding_distributed, date_key) AS outstanding
FROM fact_channel_daily WHERE date_key BETWEEN {_first} AND {_last} GROUP BY 1"""
B["vc18_outstanding_liability"] = f"""
SELECT channel_name, arg_max(outstanding_distributed, date_key) AS outstanding_vouchers,
       arg_max(outstanding_distributed, date_key) * {rate('sum(face_value_distributed)', 'sum(vouchers_distributed)')} AS estimated_liability
FROM fact_channel_daily GROUP BY 1"""
B["vc19_channel_rows"] = "SELECT voucher_code, lifecycle_status, face_value FROM fact_voucher_lifecycle WHERE channel_name = 'NATION_3'"
B["vc20_segment_csv"] = """
SELECT segment_id, 'Original order: "' || substr(segment_id, 2) || '"' || chr(10) || 'Refund, original order' AS note,
       CAST(NULL AS VARCHAR) AS serial, code, campaign, client, refund_reason FROM stg_campaign_segments"""

# --- reports --------------------------------------------------------------------------------
B["rp01_order_comparison"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, f.total_amount AS left_value, CAST(o_totalprice AS DECIMAL(18,2)) AS right_value,
       CASE WHEN f.order_id IS NULL THEN 'missing_left' ELSE 'different' END AS state
FROM orders LEFT JOIN fact_order AS f ON f.order_id = CAST(o_orderkey AS VARCHAR)
WHERE f.order_id IS NULL OR f.total_amount <> CAST(o_totalprice AS DECIMAL(18,2))"""
B["rp02_sku_presence"] = """
SELECT coalesce(a.sku, b.sku) AS sku, CASE WHEN b.sku IS NULL THEN 'left' ELSE 'right' END AS present_in
FROM (SELECT DISTINCT sku FROM fact_order_line_item WHERE sku IS NOT NULL) AS a
FULL JOIN (SELECT DISTINCT sku FROM dim_product WHERE sku IS NOT NULL) AS b ON a.sku = b.sku WHERE a.sku IS NULL OR b.sku IS NULL"""
B["rp03_missing_contact"] = "SELECT id, email, phone FROM stg_customers WHERE phone IS NULL OR email IS NULL"
B["rp04_order_volume_daily"] = "SELECT CAST(order_created_at AS DATE) AS period, count(*) AS orders FROM fact_order GROUP BY 1"
B["rp04_order_volume_monthly"] = "SELECT date_trunc('month', order_created_at) AS period, count(*) AS orders FROM fact_order GROUP BY 1"
for _unit, _period_sql in (("day", "order_date_key"), ("month", _month)):
    B[f"rp05_tender_by_{_unit}"] = f"""
SELECT {_period_sql} AS period, count(*) AS orders, sum(total_amount) AS total_revenue, sum(gc_amount) AS gift_card_spend,
       sum(discount_amount) AS discount_spend, sum(cash_amount) AS cash_spend, {rate('sum(cash_amount)', 'sum(total_amount)', '100')} AS cash_percent
FROM payment_split GROUP BY 1"""
_months = (200103, 200104, 200105, 200106, 200107, 200108)
B["rp06_redemption_trend"] = "SELECT channel_name, " + ", ".join(
    f"count(*) FILTER (redemption_date_key // 100 = {m}) AS m{m}" for m in _months
) + f" FROM fact_voucher_lifecycle WHERE redemption_date_key // 100 IN {_months} GROUP BY 1"
B["rp07_multiple_redemptions"] = """
SELECT channel_name, voucher_type, count(*) AS redeemed_vouchers, sum(face_value) AS face_value, sum(redemption_order_total) AS total_amount
FROM fact_voucher_lifecycle WHERE is_redeemed AND is_dual_redemption GROUP BY ALL"""
_product_months = (
    "SELECT p.product_key, p.full_title, "
    + ", ".join(f"coalesce(sum(quantity_ordered) FILTER (order_date_key // 100 = {m}), 0) AS m{m}" for m in _months)
    + f", coalesce(sum(quantity_ordered) FILTER (order_date_key // 100 IN {_months}), 0) AS total_units "
    "FROM dim_product p LEFT JOIN fact_order_line_item f ON f.product_key = p.product_key WHERE p.product_key > 0 GROUP BY ALL"
)
B["rp08_popular_products"] = _product_months
B["rp09_least_products"] = _product_months
B["rp10_new_products"] = """
SELECT product_created_date, product_status, count(*) AS variants, count(sku) AS skus FROM dim_product WHERE product_key > 0 GROUP BY ALL"""
B["rp11_brand_channel_sales"] = """
SELECT sku, product_title, sum(quantity_ordered) AS quantity, sum(quantity_ordered * unit_cost) AS total_cost, sum(net_amount) AS total_price
FROM fact_order_line_item WHERE vendor = 'Brand#4'
  AND order_id IN (SELECT redemption_order_id FROM dim_voucher WHERE channel_name = 'NATION_3' AND redemption_order_id IS NOT NULL) GROUP BY ALL"""
_tiers = ("Standard Bank Platinum", "Standard Bank Gold", "Standard Bank Silver")
B["rp12_membership_orders"] = f"SELECT {_month} AS month, " + ", ".join(
    f"count(*) FILTER (membership_tier = '{t}') AS {t.lower().replace(' ', '_')}" for t in _tiers
) + " FROM fact_order f JOIN dim_customer c ON c.customer_key = f.customer_key WHERE membership_tier IS NOT NULL GROUP BY 1"
B["rp13_incomplete_redemptions"] = """
SELECT * FROM dim_voucher WHERE voucher_key > 0 AND is_redeemed
  AND (redemption_order_id IS NULL OR redemption_date IS NULL OR campaign_name IS NULL OR channel_key = 0 OR NOT is_distributed)"""
