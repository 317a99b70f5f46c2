"""Sessions, capped lists and registered keys."""

from __future__ import annotations

from oracle.sql import cte, digits

M: dict[str, str] = {}

cte(
    "visits",
    """
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS conversions,
       count(*) FILTER (event_type = 'purchase') > 0 AS converted, sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS value
FROM (
  SELECT *, sum(CASE WHEN ts <= ended + INTERVAL 30 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ended FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL) AS e
) AS marked GROUP BY user_id, visit""",
)
M["ev01_sessions"] = "SELECT * FROM visits"
M["ev02_conversion_by_day"] = """
SELECT CAST(session_start AS DATE) AS day, count(*) AS sessions, count(*) FILTER (converted) AS converting_sessions, sum(value) AS value,
       round(count(*) FILTER (converted) * 100.0::DOUBLE / count(*), 4) AS conversion_rate
FROM visits GROUP BY 1"""

_listed = "(SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY id) AS place FROM stg_order_line_items) AS listed"
M["sc18_kept_lines"] = f"SELECT * FROM {_listed} WHERE place <= 3"
M["sc18_overflow_lines"] = f"SELECT * FROM {_listed} WHERE place > 3"
_report = "SELECT 'stg_order_line_items' AS entity, {0} AS list_limit, count(DISTINCT order_id) AS parents, count(*) AS rows_cut, 0 AS cut_at_source FROM " + _listed + " WHERE place > {0}"
M["sc18_truncation_report"] = _report.format(100) + " UNION ALL " + _report.format(3)

M["tf09_registered_keys"] = f"""
SELECT -1 AS product_key, NULL AS variant_id, NULL AS product_id
UNION ALL
SELECT CASE WHEN late THEN row_number() OVER (PARTITION BY late ORDER BY id) + (SELECT count(*) FROM known WHERE NOT late)
            ELSE row_number() OVER (PARTITION BY late ORDER BY id) END, variant_id, product_id
FROM known"""
cte(
    "known",
    f"""
SELECT v.id, {digits('v.id')} AS variant_id, {digits('p.id')} AS product_id, CAST({digits('v.id')} AS BIGINT) % 7 = 3 AS late
FROM stg_product_variants v JOIN stg_products p ON p.id = v.product_id""",
)

# From a bulk export come the rows of the nested documents whose parent is among the orders.
_of_order = "order_id IN (SELECT id FROM stg_orders)"
M["bx01_orders"] = "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS landing_site, CAST(NULL AS VARCHAR) AS referring_site) FROM stg_orders"
for _n, _table in (
    (2, "order_line_items"), (3, "order_transactions"), (4, "order_tax_lines"), (5, "order_discount_applications"), (6, "order_shipping_lines"),
    (7, "fulfillments"), (9, "refunds"),
):
    M[f"bx{_n:02d}_{_table}"] = f"SELECT * FROM stg_{_table} WHERE {_of_order}"
M["bx08_fulfillment_line_items"] = f"SELECT * FROM stg_fulfillment_line_items WHERE fulfillment_id IN (SELECT id FROM stg_fulfillments WHERE {_of_order})"
M["bx10_refund_line_items"] = f"SELECT * FROM stg_refund_line_items WHERE refund_id IN (SELECT id FROM stg_refunds WHERE {_of_order})"
M["bx11_orphans"] = f"""
SELECT * FROM (
  SELECT 'lines' AS page, count(DISTINCT order_id) AS parents, count(*) AS lines FROM stg_order_line_items WHERE NOT {_of_order}
  UNION ALL SELECT 'fulfillment_lines', count(DISTINCT fulfillment_id), count(*) FROM stg_fulfillment_line_items
    WHERE fulfillment_id NOT IN (SELECT id FROM stg_fulfillments WHERE {_of_order})
  UNION ALL SELECT 'refund_lines', count(DISTINCT refund_id), count(*) FROM stg_refund_line_items
    WHERE refund_id NOT IN (SELECT id FROM stg_refunds WHERE {_of_order})
) AS lost WHERE lines > 0"""
