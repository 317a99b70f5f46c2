"""The staging tables, derived again from the generated tables in plain SQL."""

from __future__ import annotations

from oracle.sql import after, cents, cte, cycle, gid, half_up, pad, units

EXTRACTED = "TIMESTAMP '2001-12-31 00:00:00'"

# --- lines ------------------------------------------------------------------------
cte(
    "base_lines",
    f"""
SELECT l.*, CAST(l_quantity AS INTEGER) AS qty, {cents('l_extendedprice')} AS gross,
       {cents(f"round({cents('l_extendedprice')} * CAST(l_discount AS DECIMAL(4,2)), 2)")} AS discount
FROM lineitem l
""",
)
cte(
    "line_amounts",
    f"""
SELECT *, gross - discount AS net,
       {cents("round(CAST(gross - discount AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)")} AS tax,
       'gid://store/LineItem/' || {pad('l_orderkey', 10)} || {pad('l_linenumber', 2)} || {pad('l_partkey', 9)}
         || {pad('l_suppkey', 8)} || {pad(f"CAST({units('gross')} AS BIGINT)", 12)} AS line_id
FROM base_lines
""",
)
cte(
    "stg_order_line_items",
    f"""
SELECT line_id AS id,
       CASE WHEN (l_orderkey + l_linenumber) % 499 = 0 THEN 'gid://store/Order/9' || {pad('l_orderkey', 12)}
            ELSE {gid('Order', 'l_orderkey')} END AS order_id,
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            WHEN l_partkey % 89 = 5 THEN 'gid://store/ProductVariant/8' || {pad('l_partkey', 12)}
            ELSE {gid('ProductVariant', 'l_partkey')} END AS variant_id,
       CASE WHEN l_partkey % 97 <> 0 THEN {gid('Product', 'l_partkey // 4')} END AS product_id,
       'Item ' || l_partkey AS title,
       CASE WHEN l_partkey % 4 = 0 THEN 'Default Title' ELSE 'Option ' || (l_partkey % 4) END AS variant_title,
       CASE WHEN l_partkey % 61 <> 0 THEN 'SKU-' || l_partkey END AS sku,
       qty AS quantity,
       CASE WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 0
            WHEN l_returnflag = 'A' THEN qty - 1 ELSE qty END AS current_quantity,
       CASE WHEN l_linestatus = 'O' THEN qty WHEN qty > 40 THEN 1 ELSE 0 END AS unfulfilled_quantity,
       {half_up(f"{units('gross')} ", "CAST(qty AS HUGEINT) * 100")} AS unit_price,
       gross AS total_price, discount AS total_discount, net AS discounted_total,
       l_partkey % 200 = 7 AS is_gift_card, l_partkey % 10 <> 9 AS taxable, l_partkey % 200 <> 7 AS requires_shipping,
       CASE WHEN l_linestatus = 'O' THEN qty WHEN qty > 40 THEN 1 ELSE 0 END AS fulfillable_quantity,
       {EXTRACTED} AS extracted_at
FROM line_amounts
""",
)
# --- order headers ------------------------------------------------------------------
cte(
    "line_sums",
    """
SELECT l_orderkey AS sum_key, sum(net) AS subtotal, sum(discount) AS discounts, sum(tax) AS taxes,
       sum(net) FILTER (WHERE l_returnflag = 'R') AS returned
FROM line_amounts GROUP BY l_orderkey
""",
)
cte(
    "placed_orders",
    f"""
SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
       {cents('o_totalprice')} AS list_price,
       CASE WHEN o_orderkey % 101 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE {cents('o_totalprice')} END AS total,
       o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS placed,
       CASE WHEN o_orderkey % 50 <> 0 AND o_custkey % 17 <> 16 THEN {gid('Customer', 'o_custkey')} END AS customer_id
FROM orders
""",
)
cte(
    "order_base",
    """
SELECT p.*, subtotal, discounts, taxes, returned, c_mktsegment, n_nationkey, n_name, r_name,
       CASE WHEN returned IS NULL THEN NULL
            WHEN k % 8 = 0 THEN total
            WHEN k % 8 = 1 THEN round(total * CAST(0.99 AS DECIMAL(4,2)), 2)
            WHEN k % 8 = 2 THEN round(total * CAST(0.9899 AS DECIMAL(6,4)), 2)
            WHEN k % 8 = 3 THEN 0
            ELSE least(returned, total) END AS refunded,
       NULLIF(CASE WHEN k % 31 = 0 THEN '' WHEN k % 43 = 0 THEN 'The "Old" ' || c_mktsegment ELSE c_mktsegment END, '') AS city
FROM placed_orders p
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey
LEFT JOIN line_sums ON sum_key = k
""",
)


def _address(prefix: str, absent: str, city: str) -> str:
    parts = {
        "city": city,
        "province": "CASE WHEN k % 47 <> 0 THEN r_name END",
        "province_code": "substr(r_name, 1, 2)",
        "country": "n_name",
        "country_code": "CASE WHEN n_nationkey % 5 = 0 THEN 'ZA' ELSE 'N' || n_nationkey END",
        "postal_code": pad("n_nationkey", 4),
    }
    return ",\n       ".join(
        f"CASE WHEN k % {absent} <> 0 THEN {value} END AS {prefix}_{name}" for name, value in parts.items()
    )


cte(
    "stg_orders",
    f"""
SELECT {gid('Order', 'k')} AS id, CAST(k AS VARCHAR) AS o_num, '#' || k AS name,
       CASE WHEN k % 10 <> 3 THEN 'buyer' || o_custkey || '@example.com' END AS email,
       placed AS created_at, placed + INTERVAL 5 MINUTE AS processed_at,
       {after('placed', 'k % 10')} AS updated_at,
       CASE WHEN k % 37 = 0 THEN placed + INTERVAL 1 DAY END AS cancelled_at,
       CASE WHEN o_orderstatus = 'F' THEN placed + INTERVAL 30 DAY END AS closed_at,
       CASE WHEN k % 37 = 0 THEN {cycle('k', ['CUSTOMER', 'INVENTORY', 'FRAUD'])} END AS cancel_reason,
       CASE WHEN k % 20 = 0 THEN 'USD' ELSE 'ZAR' END AS currency_code,
       coalesce(subtotal, 0) AS subtotal_price, coalesce(discounts, 0) AS total_discounts,
       coalesce(taxes, 0) AS total_tax,
       CAST(CASE k % 3 WHEN 0 THEN 0 WHEN 1 THEN 60 - k % 5 ELSE 130 - (k % 5) * 2 END AS DECIMAL(18,2)) AS total_shipping,
       total AS total_price, refunded AS total_refunded,
       CASE WHEN k % 41 = 0 THEN 'REFUNDED' WHEN o_orderstatus = 'F' THEN 'PAID'
            WHEN o_orderstatus = 'P' THEN 'PARTIALLY_REFUNDED' ELSE 'PENDING' END AS financial_status,
       CASE WHEN o_orderstatus = 'F' THEN 'FULFILLED'
            WHEN o_orderstatus = 'P' THEN (CASE WHEN k % 2 = 0 THEN 'PARTIAL' ELSE 'PARTIALLY_FULFILLED' END)
            ELSE 'UNFULFILLED' END AS fulfillment_status,
       customer_id, CAST(o_custkey AS VARCHAR) AS raw_customer,
       NULLIF(concat_ws(',', CASE WHEN k % 9 = 0 THEN 'VIP' END, CASE WHEN k % 7 = 0 THEN 'B2B' END,
                        CASE WHEN k % 13 = 0 THEN 'GIFT' END), '') AS tags,
       CASE WHEN k % 17 = 0 THEN 'Leave at "door", please' END AS note,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'web' WHEN '2-HIGH' THEN 'pos' WHEN '3-MEDIUM' THEN 'mobile'
            WHEN '5-LOW' THEN 'marketplace' END AS source_name,
       CASE WHEN k % 8 = 0 THEN NULL WHEN k % 8 < 3 THEN 'https://shop.example.com/products/p' || (k % 5) || '?ref=mail'
            WHEN k % 8 < 6 THEN '/collections/c' || (k % 3) ELSE 'https://shop.example.com' END AS landing_site,
       CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 < 3 THEN 'https://search' || (k % 2) || '.example.org/find?q=x'
            ELSE 'https://news.example.net/story' END AS referring_site,
       CAST(NULL AS VARCHAR) AS checkout_id,
       {_address('ship', '29', 'city')},
       {_address('bill', '53', "CASE WHEN k % 6 = 0 THEN 'Billing ' || c_mktsegment ELSE city END")},
       k % 29 <> 0 AS has_shipping, k % 53 <> 0 AS has_billing,
       {EXTRACTED} AS extracted_at
FROM order_base
""",
)
# --- children of an order -------------------------------------------------------------
cte(
    "stg_order_transactions",
    f"""
SELECT {gid('Transaction', 'k * 10 + i')} AS id, {gid('Order', 'k')} AS order_id,
       CASE WHEN (k + i) % 11 = 0 THEN 'REFUND' ELSE 'SALE' END AS kind,
       CASE WHEN (k + i) % 7 = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
       {cycle('k + i', ['gift_card', 'payfast', 'payflex', 'card_payments', 'manual'])} AS gateway,
       round(list_price * CAST(0.25 AS DECIMAL(4,2)), 2) AS amount,
       CASE WHEN k % 20 = 0 THEN 'USD' ELSE 'ZAR' END AS currency_code,
       placed + to_minutes(least(i, 3)) AS created_at,
       placed + to_minutes(least(i, 3)) + INTERVAL 30 SECOND AS processed_at,
       CASE WHEN (k + i) % 7 = 0 THEN 'CARD_DECLINED' END AS error_code, {EXTRACTED} AS extracted_at
FROM (SELECT *, unnest(range(1, k % 5 + 1)) AS i FROM placed_orders) AS copies
""",
)
cte(
    "stg_order_tax_lines",
    f"""
SELECT {gid('Order', 'k')} AS order_id, i AS line_number,
       CASE i WHEN 1 THEN 'VAT' WHEN 2 THEN 'Environmental Levy' ELSE 'Duty' END AS title,
       CAST(rate AS DECIMAL(10,6)) AS rate, round(list_price * rate, 2) AS price, {EXTRACTED} AS extracted_at
FROM (SELECT *, CAST(CASE i WHEN 1 THEN 0.15 WHEN 2 THEN 0.02 ELSE 0.01 END AS DECIMAL(4,2)) AS rate
      FROM (SELECT *, unnest(range(1, (CASE WHEN k % 97 = 0 THEN 3 ELSE 1 + k % 2 END) + 1)) AS i FROM placed_orders) AS c) AS rated
""",
)
cte(
    "stg_order_discount_applications",
    f"""
SELECT {gid('Order', 'k')} AS order_id, i AS line_number,
       CASE WHEN code IS NULL THEN 'ManualDiscountApplication' ELSE 'DiscountCodeApplication' END AS discount_type,
       code, CASE WHEN code IS NULL THEN 'Goodwill' END AS title,
       CASE WHEN code IS NULL THEN 'Manual adjustment' END AS description,
       CASE WHEN (k + i) % 2 = 0 THEN 'PricingPercentageValue' ELSE 'MoneyV2' END AS value_type,
       CASE WHEN (k + i) % 2 <> 0 THEN CAST(k % 500 AS DECIMAL(18,2)) + 0.99 END AS value_amount,
       CASE WHEN (k + i) % 2 = 0 THEN CAST(k % 50 AS DECIMAL(5,2)) + 0.50 END AS value_percentage,
       'LINE_ITEM' AS target_type, 'ACROSS' AS allocation_method, {EXTRACTED} AS extracted_at
FROM (SELECT *, CASE WHEN k % 4 = 2 AND i = 1 THEN 'VC' || {pad('k', 14)}
                     WHEN k % 20 = 3 AND i = 1 THEN 'VC' || {pad('k - 1', 14)}
                     WHEN (k + i) % 3 <> 1 THEN {cycle('k', ['PROMO-', 'STAFF-', 'WELCOME-'])} || {pad('k % 12', 2)} END AS code
      FROM (SELECT *, unnest(range(1, (CASE WHEN k % 3 = 0 THEN 0 WHEN k % 4 = 1 THEN 2 ELSE 1 END) + 1)) AS i
            FROM placed_orders) AS c) AS coded
""",
)
cte(
    "stg_order_shipping_lines",
    f"""
SELECT {gid('ShippingLine', 'k * 10 + i')} AS id, {gid('Order', 'k')} AS order_id,
       {cycle('k + i', ['Standard Shipping', 'Express Overnight', 'Click and Collect'])} AS title,
       {cycle('k + i', ['STD', 'EXP', 'CNC'])} AS code, 'rates' AS source,
       CAST(50 + i * 10 AS DECIMAL(18,2)) AS original_price, CAST(50 + i * 10 - k % 5 AS DECIMAL(18,2)) AS discounted_price,
       {cycle('k + i', ['standard', 'express', 'pickup', None])} AS carrier_identifier, {EXTRACTED} AS extracted_at
FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM placed_orders) AS copies
""",
)
cte(
    "stg_fulfillments",
    f"""
SELECT 'gid://store/Fulfillment/' || {pad('k', 10)} || {pad('s', 8)} AS id, {gid('Order', 'k')} AS order_id,
       CASE WHEN k % 9 = 0 THEN 'PENDING' WHEN k % 21 = 1 THEN 'CANCELLED' ELSE 'SUCCESS' END AS status,
       made AS created_at, made + INTERVAL 1 DAY AS updated_at,
       CASE WHEN (k + s) % 4 <> 0 THEN 'TRK' || k || '-' || s END AS tracking_number,
       CASE WHEN (k + s) % 4 <> 0 THEN {cycle('s', ['Courier One', 'Courier Two'])} END AS tracking_company,
       CASE WHEN (k + s) % 4 <> 0 THEN 'https://track.example.com/' || k || '/' || s END AS tracking_url,
       CASE WHEN k % 23 <> 0 THEN {gid('Location', 's')} END AS location_id, 'manual' AS service,
       {cycle('k', ['DELIVERED', 'IN_TRANSIT', None])} AS shipment_status, shipped_units AS total_quantity,
       {EXTRACTED} AS extracted_at
FROM (SELECT k, s, shipped_units,
             CASE s % 6 WHEN 0 THEN placed + to_seconds(86040) WHEN 1 THEN placed + to_seconds(86400)
                        WHEN 2 THEN placed + to_seconds(172800) WHEN 3 THEN placed + to_seconds(259560)
                        WHEN 4 THEN placed - to_seconds(3600) ELSE first_ship END AS made
      FROM (SELECT l_orderkey, l_suppkey AS s, min(l_shipdate) AS first_ship, sum(CAST(l_quantity AS INTEGER)) AS shipped_units
            FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL) AS shipped
      JOIN placed_orders ON k = l_orderkey) AS timed
""",
)
cte(
    "stg_fulfillment_line_items",
    f"""
SELECT 'gid://store/Fulfillment/' || {pad('l_orderkey', 10)} || {pad('l_suppkey', 8)} AS fulfillment_id,
       line_id AS line_item_id, qty AS quantity, gross AS original_total, net AS discounted_total, {EXTRACTED} AS extracted_at
FROM line_amounts WHERE l_linestatus = 'F'
""",
)
cte(
    "stg_refunds",
    f"""
SELECT {gid('Refund', 'k')} AS id, {gid('Order', 'k')} AS order_id, {after('placed', 'k % 60')} AS created_at,
       CASE WHEN k % 5 = 0 THEN 'Damaged' END AS note, refunded AS total_refunded, {EXTRACTED} AS extracted_at
FROM order_base WHERE returned IS NOT NULL
""",
)
cte(
    "stg_refund_line_items",
    f"""
SELECT {gid('Refund', 'l_orderkey')} AS refund_id, line_id AS line_item_id, qty AS quantity,
       {cycle('l_partkey', ['RETURN', 'CANCEL', 'NO_RESTOCK', 'LEGACY_RESTOCK'])} AS restock_type,
       CASE WHEN l_partkey % 3 <> 0 THEN {gid('Location', 'l_suppkey')} END AS location_id,
       net AS subtotal_amount, tax AS total_tax_amount, {EXTRACTED} AS extracted_at
FROM line_amounts WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT k FROM placed_orders)
""",
)
# --- master data ----------------------------------------------------------------------
cte(
    "stg_customers",
    f"""
SELECT {gid('Customer', 'k')} AS id, CAST(k AS VARCHAR) AS cust_num,
       CASE WHEN k % 10 <> 3 THEN 'buyer' || k || '@example.com' END AS email,
       CASE WHEN k % 3 <> 0 THEN '+27' || {pad('k', 9)} END AS phone,
       CASE WHEN k % 7 <> 0 THEN 'First' || k END AS first_name, CASE WHEN k % 14 <> 0 THEN c_name END AS last_name,
       {cycle('k', ['SUBSCRIBED', 'PENDING', 'UNSUBSCRIBED', None])} AS email_marketing_state,
       {cycle('k', ['NOT_SUBSCRIBED', 'SUBSCRIBED', None])} AS sms_marketing_state,
       {after("TIMESTAMP '1994-06-01 08:00:00'", 'k % 2000')} AS created_at,
       {after("TIMESTAMP '1994-06-01 08:00:00'", 'k % 2000 + k % 30')} AS updated_at,
       k % 9 AS number_of_orders, {cents('c_acctbal')} AS amount_spent,
       CASE WHEN k % 19 <> 0 THEN c_mktsegment END AS home_city, CASE WHEN k % 19 <> 0 THEN n_name END AS home_country,
       CASE WHEN k % 19 <> 0 THEN {pad('n_nationkey', 4)} END AS home_zip,
       {cycle('k', ['SB-Platinum', 'newsletter,SB-Gold', 'SB-Silver,wholesale', 'VIP', 'wholesale'] + [None] * 5)} AS tags,
       CASE WHEN k % 12 = 0 THEN 'Prefers email' END AS note, k % 25 = 0 AS tax_exempt, {EXTRACTED} AS extracted_at
FROM (SELECT c_custkey AS k, c_name, c_acctbal, c_mktsegment, n_name, n_nationkey
      FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey) AS people
""",
)
cte(
    "stg_products",
    f"""
SELECT {gid('Product', 'n')} AS id, p_name || ' ' || n AS title, 'product-' || n AS handle, 'Type ' || p_type AS description,
       p_type AS product_type, p_brand AS vendor, status, made AS created_at, made + INTERVAL 1 DAY AS updated_at,
       CASE WHEN status <> 'DRAFT' THEN made + INTERVAL 2 DAY END AS published_at,
       CASE n % 3 WHEN 0 THEN 'new,sale' WHEN 1 THEN p_type END AS tags, {EXTRACTED} AS extracted_at
FROM (SELECT *, p_partkey // 4 AS n,
             CASE (p_partkey // 4) % 10 WHEN 0 THEN 'DRAFT' WHEN 1 THEN 'ARCHIVED' ELSE 'ACTIVE' END AS status,
             {after("TIMESTAMP '1994-01-01 00:00:00'", '(p_partkey // 4) % 1500', '(p_partkey // 4) % 86400')} AS made
      FROM part WHERE p_partkey % 4 = 0 AND (p_partkey // 4) % 151 <> 150) AS heads
""",
)
cte(
    "stg_product_variants",
    f"""
SELECT {gid('ProductVariant', 'p_partkey')} AS id, {gid('Product', 'p_partkey // 4')} AS product_id,
       CASE WHEN p_partkey % 50 = 1 THEN NULL WHEN p_partkey % 4 = 0 THEN 'Default Title'
            ELSE 'Option ' || (p_partkey % 4) END AS title,
       CASE WHEN p_partkey % 61 <> 0 THEN 'SKU-' || p_partkey END AS sku,
       CASE WHEN p_partkey % 7 <> 0 THEN {pad('p_partkey', 13)} END AS barcode, {cents('p_retailprice')} AS price,
       CASE p_partkey % 3 WHEN 0 THEN round({cents('p_retailprice')} * CAST(1.20 AS DECIMAL(4,2)), 2)
                          WHEN 1 THEN {cents('p_retailprice')} END AS compare_at_price,
       CASE WHEN p_partkey % 11 <> 0 THEN round({cents('p_retailprice')} * CAST(0.60 AS DECIMAL(4,2)), 2) END AS cost,
       p_partkey % 10 <> 9 AS taxable, p_partkey % 200 <> 7 AS requires_shipping,
       CAST(p_size AS DECIMAL(10,2)) + 0.25 AS weight,
       {cycle('p_partkey', ['GRAMS', 'Kilograms', 'POUNDS', 'OUNCES', None])} AS weight_unit,
       p_brand AS option1, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS option2,
       CASE WHEN p_partkey % 4 = 0 THEN p_name END AS option3, {gid('InventoryItem', 'p_partkey')} AS inventory_item_id,
       {after("TIMESTAMP '1994-02-01 00:00:00'", 'p_partkey % 1500')} AS created_at,
       {after("TIMESTAMP '1994-02-04 00:00:00'", 'p_partkey % 1500')} AS updated_at, {EXTRACTED} AS extracted_at
FROM part
""",
)
cte(
    "stg_locations",
    f"""
SELECT {gid('Location', 's_suppkey')} AS id, s_name AS name,
       CASE WHEN s_suppkey % 8 <> 0 THEN s_suppkey || ' Depot Street' END AS address1,
       CASE WHEN s_suppkey % 3 = 0 THEN 'Unit ' || s_suppkey END AS address2, 'City ' || n_nationkey AS city,
       CASE WHEN s_suppkey % 5 <> 0 THEN 'Province ' || (n_nationkey % 5) END AS province,
       CASE WHEN s_suppkey % 5 <> 0 THEN 'P' || (n_nationkey % 5) END AS province_code, n_name AS country,
       CASE WHEN n_nationkey % 5 = 0 THEN 'ZA' ELSE 'N' || n_nationkey END AS country_code,
       {pad('n_nationkey', 4)} AS zip, CAST(NULL AS VARCHAR) AS phone, s_suppkey % 13 <> 0 AS is_active,
       s_suppkey % 2 = 0 AS fulfills_online_orders, {EXTRACTED} AS extracted_at
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
""",
)
cte(
    "stg_inventory_levels",
    f"""
SELECT {gid('InventoryItem', 'p')} AS inventory_item_id,
       {gid('Location', 'CASE WHEN p % 70 = 0 THEN 777777777 + j ELSE (p + j * 3) % depots END')} AS location_id,
       stock AS available, CASE WHEN n % 13 <> 0 THEN coalesce(stock, 0) + p % 5 END AS on_hand, p % 5 AS committed,
       CASE WHEN p % 4 <> 3 THEN (p % 4) * 10 END AS incoming, p % 2 AS reserved,
       snapshot_date + INTERVAL 6 HOUR AS updated_at, snapshot_date, {EXTRACTED} AS extracted_at
FROM (SELECT *, CASE n % 7 WHEN 1 THEN 0 WHEN 2 THEN 9 WHEN 3 THEN 10 WHEN 4 THEN 500 WHEN 5 THEN 501
                           WHEN 6 THEN p_size END AS stock,
             CASE d WHEN -1 THEN DATE '2001-01-01' WHEN 0 THEN DATE '2001-11-30' ELSE DATE '2001-12-31' END AS snapshot_date
      FROM (SELECT p_partkey AS p, p_size, j, d, p_partkey + j + d AS n, (SELECT count(*) FROM supplier) AS depots
            FROM part, (VALUES (0), (1)) AS js(j), (VALUES (-1), (0), (1)) AS ds(d)) AS grid) AS stocked
""",
)
cte(
    "stg_abandoned_checkouts",
    f"""
SELECT {gid('Checkout', 'event_id')} AS id, ts AS created_at, ts + INTERVAL 10 MINUTE AS updated_at,
       CASE WHEN event_type = 'purchase' THEN ts + INTERVAL 1 HOUR END AS completed_at,
       CASE WHEN event_id % 6 <> 0 THEN {gid('Customer', 'user_id')} END AS customer_id,
       {cents('value')} AS subtotal_price, {cents(f"round({cents('value')} * CAST(0.15 AS DECIMAL(4,2)), 2)")} AS total_tax,
       {cents('value')} + {cents(f"round({cents('value')} * CAST(0.15 AS DECIMAL(4,2)), 2)")} AS total_price,
       'ZAR' AS currency_code, 'https://shop.example.com/recover/' || event_id AS abandoned_checkout_url,
       event_id % 4 AS line_items_count,
       CASE event_id % 4 WHEN 1 THEN '[{{"title":"Item 1","quantity":1}}]'
            WHEN 2 THEN '[{{"title":"Item 1","quantity":1}},{{"title":"Item 2","quantity":2}}]'
            WHEN 3 THEN '[{{"title":"Item 1","quantity":1}},{{"title":"Item 2","quantity":2}},{{"title":"Item 3","quantity":3}}]'
       END AS line_items_json, {EXTRACTED} AS extracted_at
FROM events WHERE event_type IN ('purchase', 'click')
""",
)
cte(
    "stg_discount_codes",
    f"""
SELECT 'gid://store/DiscountCode/' || (CASE WHEN voucher THEN 4 WHEN code LIKE 'PROMO%' THEN 1 WHEN code LIKE 'STAFF%' THEN 2 ELSE 3 END)
         || {pad('n', 12)} AS id,
       code, 'Code ' || code AS title, CASE WHEN voucher THEN 'DiscountCodeApp' ELSE 'DiscountCodeBasic' END AS discount_type,
       CASE WHEN n % 5 = 4 THEN 'EXPIRED' ELSE 'ACTIVE' END AS status,
       CASE WHEN n % 2 = 0 THEN 'DiscountPercentage' ELSE 'MoneyV2' END AS value_type,
       CASE WHEN n % 2 <> 0 THEN CAST(n % 100 + 50 AS DECIMAL(18,2)) END AS value_amount,
       CASE WHEN n % 2 = 0 THEN CAST(n % 40 + 5 AS DECIMAL(5,2)) END AS value_percentage,
       TIMESTAMP '1995-01-01 00:00:00' AS starts_at, CASE WHEN n % 3 = 0 THEN TIMESTAMP '2000-06-30 00:00:00' END AS ends_at,
       CASE WHEN n % 5 <> 0 THEN n % 100 * 10 END AS usage_limit, uses AS usage_count, voucher AS applies_once_per_customer
FROM (SELECT code, count(*) AS uses, CAST(regexp_extract(code, '[0-9]+$') AS BIGINT) AS n, code LIKE 'VC%' AS voucher
      FROM stg_order_discount_applications WHERE code IS NOT NULL GROUP BY code) AS used
""",
)
# --- voucher layer --------------------------------------------------------------------
cte(
    "voucher_base",
    f"""
SELECT k, o_custkey, customer_id, placed, 'VC' || {pad('k', 14)} AS voucher_code, k % 4 = 0 AS is_card,
       CAST(100 + (k % 9) * 50 AS DECIMAL(18,2)) AS face_value, o_orderdate - to_days(CAST(10 + k % 20 AS INTEGER)) AS made_at
FROM placed_orders WHERE k % 2 = 0
""",
)
cte(
    "stg_gift_cards",
    f"""
SELECT {gid('GiftCard', 'k')} AS id, CASE WHEN k % 100 = 0 THEN 'zzzz' ELSE right(voucher_code, 4) END AS code,
       face_value AS initial_value,
       CASE WHEN k % 12 = 0 THEN face_value WHEN k % 12 = 4 THEN 0 ELSE round(face_value * CAST(0.25 AS DECIMAL(4,2)), 2) END AS balance,
       'ZAR' AS currency_code, k % 24 <> 0 AS enabled, CAST(made_at AS DATE) + 365 AS expires_on, made_at AS created_at,
       placed AS updated_at, CASE WHEN k % 12 <> 0 THEN {gid('Order', 'k')} END AS order_id,
       CASE WHEN k % 12 <> 0 THEN customer_id END AS customer_id
FROM voucher_base WHERE is_card
""",
)
cte(
    "stg_channels",
    """
SELECT 'CH' || n_nationkey AS channel_id, n_name AS channel_name, r_name AS industry, DATE '1995-01-01' AS contract_start_date,
       CASE WHEN n_nationkey % 4 = 0 THEN DATE '2001-06-30' END AS contract_end_date, n_nationkey % 4 <> 0 AS is_active
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey
""",
)
cte(
    "stg_voucher_inventory",
    f"""
SELECT 'V' || k AS voucher_id, voucher_code, CASE WHEN is_card THEN 'gift_card' ELSE 'discount_code' END AS voucher_type,
       CASE WHEN k % 74 <> 0 THEN 'CH' || (o_custkey % 27) END AS channel_id, face_value, 'ZAR' AS currency_code,
       made_at AS created_in_store_at,
       CASE WHEN is_card AND k % 40 <> 0 THEN {gid('GiftCard', 'k')}
            WHEN NOT is_card THEN 'gid://store/DiscountCode/4' || {pad('k', 12)} END AS store_object_id,
       'allocated' AS status, 'B' || (k % 100) AS batch_id
FROM voucher_base
""",
)
cte(
    "stg_voucher_distributions",
    f"""
SELECT 'D' || k || '-' || i AS distribution_id, 'V' || k AS voucher_id, voucher_code, 'CH' || (o_custkey % 27) AS channel_id,
       CAST(sent AS DATE) - 1 AS instruction_date, sent AS distribution_date,
       CASE WHEN k % 3 <> 0 THEN 'sms' ELSE 'direct_channel' END AS distribution_method,
       CASE WHEN k % 3 <> 0 THEN {cycle('k', ['delivered', 'failed', 'delivered', 'pending'])} END AS sms_status,
       k % 8 < 4 AS subscription_flag, CASE WHEN k % 8 < 4 THEN k % 24 + 1 END AS subscription_month
FROM (SELECT *, {after('made_at', '2 + k % 7 + i')} AS sent
      FROM (SELECT *, unnest(range(1, (CASE WHEN k % 10 = 0 THEN 0 WHEN k % 50 = 2 THEN 2 ELSE 1 END) + 1)) AS i
            FROM voucher_base) AS copies) AS timed
""",
)
cte(
    "stg_campaign_segments",
    f"""
SELECT 'S' || k AS segment_id, voucher_code AS code,
       CASE WHEN k % 30 = 0 THEN 'Refund' WHEN k % 10 = 2 THEN 'Subscription 25% 24 Month Virtual'
            WHEN k % 10 = 4 THEN 'Subscription 50% 36 Month Virtual' WHEN k % 30 = 6 THEN 'In Process'
            WHEN k % 30 = 16 THEN 'NATION_3' ELSE 'Virtual' END AS campaign,
       CASE WHEN k % 30 = 0 THEN {cycle('k', ['Damaged', 'Missing items'])} WHEN k % 30 IN (6, 16) THEN 'Refund'
            WHEN k % 14 = 0 THEN 'Marketing' ELSE 'NATION_' || (o_custkey % 27) END AS client,
       CASE WHEN k % 30 = 16 THEN 'Faulty' END AS refund_reason
FROM voucher_base
""",
)
cte(
    "commission_rates",
    """
SELECT 'CH' || n_nationkey AS channel_id, 'commission' AS rate_type, CAST((n_nationkey % 10 + i * 5) / 100.0 AS DECIMAL(8,4)) AS rate_value,
       CASE i WHEN 1 THEN DATE '1995-01-01' ELSE DATE '1998-07-01' END AS effective_from,
       CASE i WHEN 1 THEN DATE '1998-07-01' END AS effective_to
FROM nation, (VALUES (1), (2)) AS versions(i)
""",
)
