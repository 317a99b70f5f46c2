"""Voucher layer in plain SQL."""

from __future__ import annotations

from oracle.sql import cte, date_key, digits, half_up, units

cte(
    "dim_channel",
    """
SELECT row_number() OVER (ORDER BY channel_id) AS channel_key, * FROM stg_channels
UNION ALL BY NAME SELECT 0 AS channel_key, 'Unknown Channel' AS channel_name
""",
)
cte("stg_channel_keys", "SELECT channel_id, channel_key, channel_name FROM dim_channel WHERE channel_id IS NOT NULL")
cte(
    "clean_segments",
    """
SELECT segment_id, code, CASE WHEN client = 'Refund' AND campaign <> 'In Process' THEN 'Refund' ELSE campaign END AS campaign,
       CASE WHEN client = 'Refund' AND campaign = 'In Process' THEN NULL WHEN client = 'Refund' THEN campaign
            WHEN campaign = 'Refund' THEN NULL ELSE client END AS client,
       CASE WHEN campaign = 'Refund' AND client <> 'Refund' THEN coalesce(refund_reason, client) ELSE refund_reason END AS refund_reason,
       client = 'Refund' OR campaign = 'Refund' AS is_refund
FROM stg_campaign_segments
""",
)
cte(
    "code_uses",
    f"""
SELECT vi.voucher_code, o.o_num AS redemption_order_id, o.created_at AS redemption_date,
       coalesce(a.value_amount, {half_up(units('o.subtotal_price') + ' * ' + units('a.value_percentage'), 'CAST(1000000 AS HUGEINT)')}) AS redeemed_amount,
       o.total_price
FROM stg_voucher_inventory vi JOIN stg_order_discount_applications a ON a.code = vi.voucher_code
JOIN stg_orders o ON o.id = a.order_id WHERE vi.voucher_type = 'discount_code'
""",
)
cte(
    "card_links",
    """
SELECT vi.voucher_code, vi.channel_id, gc.id, gc.initial_value, gc.balance, gc.expires_on, gc.order_id,
       gc.initial_value - gc.balance AS redeemed_amount
FROM stg_voucher_inventory vi JOIN stg_gift_cards gc ON gc.id = vi.store_object_id AND gc.code = right(vi.voucher_code, 4)
WHERE vi.voucher_type = 'gift_card'
""",
)
cte(
    "uses",
    """
SELECT voucher_code, redemption_order_id, redemption_date, redeemed_amount FROM code_uses
UNION ALL
SELECT voucher_code, o_num, o.created_at, redeemed_amount FROM card_links c LEFT JOIN stg_orders o ON o.id = c.order_id
WHERE balance < initial_value
""",
)
cte(
    "dim_voucher",
    f"""
SELECT row_number() OVER (ORDER BY vi.voucher_code) AS voucher_key, vi.voucher_code, vi.voucher_type, coalesce(ch.channel_key, 0) AS channel_key,
       sg.campaign AS campaign_name,
       CASE WHEN sg.campaign LIKE 'Subscription %' THEN CAST(regexp_extract(sg.campaign, '([0-9]+)%', 1) AS DECIMAL(5,2)) END AS subscription_discount_pct,
       CASE WHEN sg.campaign LIKE 'Subscription %' THEN CAST(regexp_extract(sg.campaign, '([0-9]+) Month', 1) AS INTEGER) END AS subscription_term_months,
       coalesce(sg.client = 'Marketing', false) AS is_marketing, vi.face_value, vi.currency_code, vi.status, vi.batch_id, vi.created_in_store_at,
       dd.discount_key AS store_discount_key, ds.voucher_id IS NOT NULL AS is_distributed, ds.distribution_date, ds.distribution_method,
       coalesce(ds.subscription_flag, false) AS is_subscription, ds.subscription_month, us.voucher_code IS NOT NULL AS is_redeemed,
       us.redemption_date, us.redemption_order_id, us.redeemed_amount, coalesce(cl.expires_on, dd.ends_at) AS expires_on,
       CAST(ds.distribution_date AS DATE) - CAST(vi.created_in_store_at AS DATE) AS days_in_inventory,
       CAST(us.redemption_date AS DATE) - CAST(ds.distribution_date AS DATE) AS days_to_redemption,
       coalesce(ch.channel_name, 'Unknown Channel') AS channel_name
FROM stg_voucher_inventory vi
LEFT JOIN (SELECT * FROM stg_voucher_distributions
           QUALIFY row_number() OVER (PARTITION BY voucher_id ORDER BY distribution_date, distribution_id) = 1) AS ds ON ds.voucher_id = vi.voucher_id
LEFT JOIN (SELECT * FROM uses
           QUALIFY row_number() OVER (PARTITION BY voucher_code ORDER BY redemption_date NULLS LAST, redemption_order_id) = 1) AS us ON us.voucher_code = vi.voucher_code
LEFT JOIN clean_segments sg ON sg.code = vi.voucher_code
LEFT JOIN card_links cl ON cl.voucher_code = vi.voucher_code
LEFT JOIN dim_discount dd ON vi.voucher_type = 'discount_code' AND dd.discount_id = {digits('vi.store_object_id')}
LEFT JOIN stg_channel_keys ch ON ch.channel_id = vi.channel_id
UNION ALL BY NAME SELECT 0 AS voucher_key, 0 AS channel_key
""",
)
cte(
    "dual_orders",
    f"""
SELECT DISTINCT {digits('order_id')} AS redemption_order_id FROM stg_order_transactions WHERE gateway = 'gift_card'
  AND order_id IN (SELECT order_id FROM stg_order_discount_applications)
""",
)
cte(
    "fact_voucher_lifecycle",
    f"""
SELECT v.voucher_key AS voucher_lifecycle_key, v.voucher_key, v.channel_key, {date_key('v.created_in_store_at')} AS creation_date_key,
       {date_key('v.distribution_date')} AS distribution_date_key, {date_key('v.redemption_date')} AS redemption_date_key,
       CASE WHEN expired THEN {date_key('v.expires_on')} END AS expiry_date_key, CASE WHEN v.is_redeemed THEN fp.product_key END AS product_key,
       v.voucher_code, v.voucher_type, v.batch_id,
       CASE WHEN v.is_redeemed THEN 'redeemed' WHEN expired THEN 'expired' WHEN v.is_distributed THEN 'distributed' ELSE 'created' END AS lifecycle_status,
       v.is_distributed, v.is_redeemed, expired AS is_expired,
       v.redemption_order_id IS NOT NULL AND v.redemption_order_id IN (SELECT redemption_order_id FROM dual_orders) AS is_dual_redemption,
       v.face_value, fo.total_amount AS redemption_order_total, v.redeemed_amount AS redemption_discount_amount,
       CASE WHEN v.is_redeemed THEN CAST(fo.total_amount AS DECIMAL(18,2)) - CAST(v.redeemed_amount AS DECIMAL(18,2)) END AS overspend,
       CASE WHEN expired THEN v.face_value WHEN v.is_redeemed THEN CAST(v.face_value AS DECIMAL(18,2)) - CAST(v.redeemed_amount AS DECIMAL(18,2)) END AS breakage_amount,
       CAST(v.distribution_date AS DATE) - CAST(v.created_in_store_at AS DATE) AS days_creation_to_distribution,
       CAST(v.redemption_date AS DATE) - CAST(v.distribution_date AS DATE) AS days_distribution_to_redemption,
       CAST(v.redemption_date AS DATE) - CAST(v.created_in_store_at AS DATE) AS days_creation_to_redemption,
       v.is_subscription, v.subscription_month, v.distribution_method, v.channel_name, fo.order_number AS redemption_order_number
FROM (SELECT *, coalesce(NOT is_redeemed AND expires_on < DATE '2001-12-31', false) AS expired FROM dim_voucher WHERE voucher_key > 0) AS v
LEFT JOIN fact_order fo ON fo.order_id = v.redemption_order_id
LEFT JOIN (SELECT order_id, arg_min(product_key, line_item_id) AS product_key FROM fact_order_line_item GROUP BY 1) AS fp ON fp.order_id = v.redemption_order_id
""",
)
_ROLES = {"created": "creation", "distributed": "distribution", "redeemed": "redemption", "expired": "expiry"}
cte(
    "role_days",
    " UNION ALL ".join(
        f"SELECT channel_key, {column}_date_key AS date_key, '{role}' AS role, face_value AS face, "
        f"coalesce(redemption_order_total, 0) AS total, coalesce(overspend, 0) AS over, coalesce(breakage_amount, 0) AS broke "
        f"FROM fact_voucher_lifecycle WHERE {column}_date_key IS NOT NULL"
        for role, column in _ROLES.items()
    ),
)
_counts = ", ".join(f"count(*) FILTER (role = '{r}') AS vouchers_{r}" for r in _ROLES)
_faces = ", ".join(
    f"coalesce(sum(face) FILTER (role = '{r}'), 0) AS face_value_{r}" for r in ("created", "distributed", "redeemed")
)
cte(
    "active_days",
    f"""
SELECT channel_key, date_key, {_counts}, {_faces}, coalesce(sum(total) FILTER (role = 'redeemed'), 0) AS redemption_order_revenue,
       coalesce(sum(over) FILTER (role = 'redeemed'), 0) AS overspend_total, coalesce(sum(broke) FILTER (role = 'expired'), 0) AS breakage_total
FROM role_days GROUP BY ALL
""",
)
_zeros = ", ".join(
    f"coalesce(a.{c}, 0) AS {c}"
    for c in (
        "vouchers_created vouchers_distributed vouchers_redeemed vouchers_expired face_value_created face_value_distributed "
        "face_value_redeemed redemption_order_revenue overspend_total breakage_total"
    ).split()
)
_running = ", ".join(
    f"sum(vouchers_{r}) OVER (PARTITION BY channel_key ORDER BY date_key) AS cumulative_{r}"
    for r in ("created", "distributed", "redeemed")
)
cte(
    "dense_days",
    f"""
SELECT g.channel_key, g.date_key, {_zeros}
FROM (SELECT channel_key, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key
      FROM (SELECT channel_key, unnest(generate_series(strptime(CAST(min(date_key) AS VARCHAR), '%Y%m%d'),
                   (SELECT strptime(CAST(max(date_key) AS VARCHAR), '%Y%m%d') FROM active_days), INTERVAL 1 DAY)) AS day
            FROM active_days GROUP BY channel_key) AS spans) AS g
LEFT JOIN active_days a ON a.channel_key = g.channel_key AND a.date_key = g.date_key
""",
)
cte(
    "fact_channel_daily",
    f"""
SELECT row_number() OVER (ORDER BY r.channel_key, r.date_key) AS channel_daily_key, r.*,
       cumulative_distributed - cumulative_redeemed AS outstanding_distributed,
       CASE WHEN cumulative_created > 0 THEN {half_up('CAST(cumulative_distributed AS HUGEINT) * 100', 'CAST(cumulative_created AS HUGEINT)')} END AS distribution_rate,
       CASE WHEN cumulative_distributed > 0 THEN {half_up('CAST(cumulative_redeemed AS HUGEINT) * 100', 'CAST(cumulative_distributed AS HUGEINT)')} END AS redemption_rate,
       c.channel_name
FROM (SELECT *, {_running} FROM dense_days) AS r LEFT JOIN dim_channel c ON c.channel_key = r.channel_key
""",
)
cte(
    "ref_commission_rate",
    """
SELECT row_number() OVER (ORDER BY channel_key, rate_type, effective_from) AS commission_rate_key, channel_key, rate_type, rate_value,
       effective_from, effective_to
FROM commission_rates r JOIN stg_channel_keys c ON c.channel_id = r.channel_id
""",
)
cte(
    "payment_split",
    f"""
SELECT o.order_key, o.order_number, o.order_date_key, o.customer_key, coalesce(gc, 0) AS gc_amount, o.discount_amount,
       coalesce(cash, 0) AS cash_amount, o.total_amount, coalesce(gc, 0) > 0 AS has_gift_card, o.discount_amount > 0 AS has_discount_code,
       coalesce(gc, 0) > 0 AND o.discount_amount > 0 AS is_dual_redemption, v.voucher_code, v.voucher_key, v.channel_key, v.channel_name
FROM fact_order o
LEFT JOIN (SELECT {digits('order_id')} AS oid, sum(amount) FILTER (gateway = 'gift_card') AS gc, sum(amount) FILTER (gateway <> 'gift_card') AS cash
           FROM stg_order_transactions WHERE kind = 'SALE' AND status = 'SUCCESS' GROUP BY 1) AS t ON t.oid = o.order_id
LEFT JOIN (SELECT * FROM dim_voucher WHERE redemption_order_id IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY redemption_order_id ORDER BY voucher_key) = 1) AS v ON v.redemption_order_id = o.order_id
""",
)
