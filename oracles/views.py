"""Shared views: raw tables from the Parquet tables, cleaned tables, marts, flat items.

Order matters: a view may use those above it.
"""

from tradewind.sources.testdata import STATEMENTS

STATEMENT_LIST = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in STATEMENTS) + "]"
STATEMENT_COUNT = len(STATEMENTS)

LINE_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate"


def days(end: str, start: str) -> str:
    return f"(date_diff('microsecond', {start}, {end})::DOUBLE / 86400e6)"


# The words of the delivery status.
DELIVERY = f"""
    CASE WHEN order_status = 'delivered'
          AND order_delivered_customer_date > order_estimated_delivery_date
         THEN 1 ELSE 0 END AS is_late_delivery,
    CASE WHEN order_status <> 'delivered' THEN 'not_delivered'
         WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 'late'
         ELSE 'on_time_or_early' END AS delivery_status,
    {days('order_delivered_customer_date', 'order_estimated_delivery_date')} AS delivery_delay_days
"""

VIEWS: dict[str, str] = {
    "raw_orders": """
SELECT k::VARCHAR AS order_id, k::VARCHAR AS customer_id,
  CASE s WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END AS order_status,
  d + to_seconds((k * 37) % 86400) AS order_purchase_timestamp,
  d + to_seconds((k * 37) % 86400 + 3600) AS order_approved_at,
  d + INTERVAL 2 DAY AS order_delivered_carrier_date,
  CASE WHEN (s = 'F' AND k % 50 <> 0) OR (s = 'P' AND k % 97 = 0)
       THEN d + to_seconds((5 + k % 23) * 86400 + (k * 53) % 86400) END
    AS order_delivered_customer_date,
  d + to_days((10 + k % 20)::INTEGER) AS order_estimated_delivery_date
FROM (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderdate AS d FROM orders)
""",
    "raw_customers": """
SELECT o_orderkey::VARCHAR AS customer_id,
  CASE WHEN o_orderkey % 10 < 7 THEN 'u' || o_orderkey ELSE 'c' || o_custkey END
    AS customer_unique_id,
  (o_custkey % 100000)::INTEGER AS customer_zip_code_prefix,
  CASE WHEN o_orderkey % 60 = 8 THEN n_name || '_MOVED' ELSE n_name END AS customer_city,
  r_name AS customer_state
FROM orders
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
""",
    "raw_order_items": """
SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS order_item_id,
  l_partkey::VARCHAR AS product_id, l_suppkey::VARCHAR AS seller_id,
  l_shipdate AS shipping_limit_date,
  l_extendedprice::DECIMAL(16,2) AS price, l_quantity::DECIMAL(16,2) AS freight_value,
  lineitem AS line
FROM lineitem
""",
    "raw_order_payments": """
SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS payment_sequential,
  CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto' WHEN 'N' THEN 'voucher' END
    AS payment_type,
  l_quantity::INTEGER AS payment_installments,
  round(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(12,2))
        * (1 + l_tax::DECIMAL(12,2)), 2)::DECIMAL(16,2) AS payment_value,
  lineitem AS line
FROM lineitem
""",
    "raw_order_reviews": """
SELECT prefix || o_orderkey AS review_id, o_orderkey::VARCHAR AS order_id,
  (CASE prefix WHEN 'r' THEN 6 - digit ELSE digit END)::DOUBLE AS review_score,
  NULL::VARCHAR AS review_comment_title,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS review_comment_message,
  o_orderdate + to_days((10 + o_orderkey % 20)::INTEGER) AS review_creation_date,
  o_orderdate + to_days((11 + o_orderkey % 20)::INTEGER) AS review_answer_timestamp
FROM (SELECT *, left(o_orderpriority, 1)::INTEGER AS digit FROM orders)
CROSS JOIN (VALUES ('r'), ('s')) p(prefix)
WHERE (prefix = 'r' AND o_orderkey % 11 <> 0) OR (prefix = 's' AND o_orderkey % 13 = 0)
""",
    "raw_products": """
SELECT p_partkey::VARCHAR AS product_id,
  CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS product_category_name,
  length(p_name)::DOUBLE AS product_name_lenght,
  (p_size * 10)::DOUBLE AS product_description_lenght,
  (p_size % 5)::DOUBLE AS product_photos_qty,
  p_retailprice AS product_weight_g,
  p_size::DOUBLE AS product_length_cm,
  p_size::DOUBLE AS product_height_cm,
  p_size::DOUBLE AS product_width_cm
FROM part
""",
    "raw_sellers": """
SELECT s_suppkey::VARCHAR AS seller_id, s_suppkey::INTEGER AS seller_zip_code_prefix,
  n_name AS seller_city, r_name AS seller_state
FROM supplier
JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey
""",
    "raw_category_translation": """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM part WHERE p_type <> 'PROMO'
""",
    "clean_order_items": f"""
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY
        {", ".join("line." + c.strip() for c in LINE_ORDER.split(","))}) AS nth
      FROM raw_order_items)
WHERE nth = 1
""",
    "clean_order_payments": f"""
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential ORDER BY
        {", ".join("line." + c.strip() for c in LINE_ORDER.split(","))}) AS nth
      FROM raw_order_payments)
WHERE nth = 1
""",
    # The other raw tables have unique keys; DISTINCT ON keeps the rule visible.
    "clean_customers": "SELECT DISTINCT ON (customer_id) * FROM raw_customers",
    "clean_orders": "SELECT DISTINCT ON (order_id) * FROM raw_orders",
    "clean_order_reviews": "SELECT DISTINCT ON (review_id, order_id) * FROM raw_order_reviews",
    "clean_products": "SELECT DISTINCT ON (product_id) * FROM raw_products",
    "clean_sellers": "SELECT DISTINCT ON (seller_id) * FROM raw_sellers",
    "clean_category_translation": """
SELECT DISTINCT ON (product_category_name) * FROM raw_category_translation
""",
    "item_sales": """
SELECT i.order_id, i.order_item_id, i.seller_id, i.product_id, t.product_category_name_english,
  o.order_purchase_timestamp, i.price, i.freight_value,
  (i.price + i.freight_value)::DECIMAL(17,2) AS revenue
FROM clean_order_items i
LEFT JOIN clean_orders o ON o.order_id = i.order_id
LEFT JOIN clean_products p ON p.product_id = i.product_id
LEFT JOIN clean_category_translation t ON t.product_category_name = p.product_category_name
""",
    # Copies of the cleaned tables in which some rows break each rule.
    "broken_customers": """
SELECT * REPLACE (CASE WHEN customer_id::BIGINT % 139 <> 0 THEN customer_id END AS customer_id)
FROM clean_customers
""",
    "broken_orders": """
SELECT * REPLACE (
  CASE WHEN order_id::BIGINT % 149 <> 0 THEN order_id END AS order_id,
  CASE WHEN order_id::BIGINT % 101 = 0 THEN NULL WHEN order_id::BIGINT % 103 = 0 THEN 'nobody ' || customer_id
    ELSE customer_id END AS customer_id)
FROM clean_orders
""",
    "broken_order_items": """
SELECT * REPLACE (
  CASE WHEN order_id::BIGINT % 137 <> 0 THEN order_item_id END AS order_item_id,
  CASE WHEN order_id::BIGINT % 131 = 0 THEN NULL WHEN order_id::BIGINT % 113 = 0 THEN '-1' ELSE order_id END AS order_id,
  CASE WHEN order_id::BIGINT % 109 = 0 THEN NULL WHEN order_id::BIGINT % 127 = 0 THEN 'none' ELSE product_id END AS product_id,
  CASE WHEN order_id::BIGINT % 127 = 0 THEN NULL WHEN order_id::BIGINT % 109 = 0 THEN 'none' ELSE seller_id END AS seller_id,
  CASE WHEN order_id::BIGINT % 107 = 0 THEN -price ELSE price END AS price,
  CASE WHEN order_id::BIGINT % 109 = 0 THEN -freight_value ELSE freight_value END AS freight_value)
FROM clean_order_items
""",
    "broken_order_payments": """
SELECT * REPLACE (
  CASE WHEN order_id::BIGINT % 131 = 0 THEN NULL WHEN order_id::BIGINT % 113 = 0 THEN '-1' ELSE order_id END AS order_id,
  CASE WHEN order_id::BIGINT % 137 <> 0 THEN payment_sequential END AS payment_sequential,
  CASE WHEN order_id::BIGINT % 107 = 0 THEN -payment_value ELSE payment_value END AS payment_value)
FROM clean_order_payments
""",
    "broken_order_reviews": """
SELECT * REPLACE (
  CASE WHEN order_id::BIGINT % 137 <> 0 THEN review_id END AS review_id,
  CASE WHEN order_id::BIGINT % 131 = 0 THEN NULL WHEN order_id::BIGINT % 113 = 0 THEN '-1' ELSE order_id END AS order_id,
  CASE WHEN order_id::BIGINT % 107 = 0 THEN 0 WHEN order_id::BIGINT % 109 = 0 THEN 5.9
    WHEN order_id::BIGINT % 127 = 0 THEN NULL ELSE review_score END::DOUBLE AS review_score)
FROM clean_order_reviews
""",
    "broken_products": """
SELECT * REPLACE (CASE WHEN product_id::BIGINT % 17 <> 0 THEN product_id END AS product_id)
FROM clean_products
""",
    "broken_sellers": """
SELECT * REPLACE (CASE WHEN seller_id::BIGINT % 3 <> 0 THEN seller_id END AS seller_id)
FROM clean_sellers
""",
    "broken_category_translation": """
SELECT * REPLACE (CASE WHEN product_category_name NOT LIKE 'S%' THEN product_category_name END
  AS product_category_name)
FROM clean_category_translation
""",
    "broken_item_sales": """
SELECT * REPLACE (
  CASE WHEN order_id::BIGINT % 131 <> 0 THEN order_id END AS order_id,
  CASE WHEN order_id::BIGINT % 137 <> 0 THEN order_item_id END AS order_item_id,
  CASE WHEN order_id::BIGINT % 109 <> 0 THEN product_id END AS product_id,
  CASE WHEN order_id::BIGINT % 127 <> 0 THEN seller_id END AS seller_id,
  CASE WHEN order_id::BIGINT % 107 <> 0 THEN price END AS price,
  CASE WHEN order_id::BIGINT % 113 <> 0 THEN freight_value END AS freight_value,
  CASE WHEN order_id::BIGINT % 103 <> 0 THEN revenue END AS revenue,
  CASE WHEN order_id::BIGINT % 101 <> 0 THEN order_purchase_timestamp END AS order_purchase_timestamp)
FROM item_sales
""",
    "revenue_per_order": """
SELECT order_id, sum(price + freight_value)::DECIMAL(27,2) AS order_revenue
FROM clean_order_items GROUP BY order_id
""",
    "payments_per_order": """
SELECT order_id, max(payment_installments) AS payment_installments_max,
  count(DISTINCT payment_type) AS payment_type_nunique,
  sum(payment_value)::DECIMAL(26,2) AS order_total_payment_value
FROM clean_order_payments GROUP BY order_id
""",
    "reviews_per_order": """
SELECT order_id, max(review_score) AS review_score FROM clean_order_reviews GROUP BY order_id
""",
    "m_dim_date": """
SELECT d::DATE AS date, year(d)::INTEGER AS year, month(d)::INTEGER AS month,
  quarter(d)::INTEGER AS quarter, dayname(d) AS day_of_week,
  CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT unnest(generate_series(min(order_purchase_timestamp)::DATE::TIMESTAMP,
                                    max(order_purchase_timestamp)::DATE::TIMESTAMP,
                                    INTERVAL 1 DAY)) AS d
      FROM clean_orders)
""",
    "m_dim_products": """
SELECT p.product_id, p.product_category_name,
  coalesce(t.product_category_name_english, 'unknown') AS product_category_name_english
FROM clean_products p
LEFT JOIN clean_category_translation t ON t.product_category_name = p.product_category_name
""",
    "rfm_base_v": f"""
SELECT c.customer_unique_id,
  {days("(SELECT max(order_purchase_timestamp) FROM clean_orders)",
        "max(o.order_purchase_timestamp)")} AS recency,
  count(DISTINCT o.order_id) AS frequency,
  sum(coalesce(r.order_revenue, 0))::DECIMAL(37,2) AS monetary
FROM clean_orders o
JOIN clean_customers c ON c.customer_id = o.customer_id
LEFT JOIN revenue_per_order r ON r.order_id = o.order_id
WHERE o.order_status = 'delivered'
GROUP BY c.customer_unique_id
""",
    "rfm_scores_v": """
SELECT *, r_score::VARCHAR || f_score || m_score AS rfm_score
FROM (SELECT *,
        (ntile(5) OVER (ORDER BY recency DESC NULLS FIRST, customer_unique_id))::INTEGER AS r_score,
        CASE frequency WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 5 END AS f_score,
        (ntile(5) OVER (ORDER BY monetary ASC NULLS LAST, customer_unique_id))::INTEGER AS m_score
      FROM rfm_base_v)
""",
    # Segment names, first match wins.
    "rfm_segments_v": """
SELECT *, CASE
    WHEN r_score >= 4 AND f_score >= 3 THEN 'Champions'
    WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
    WHEN r_score >= 4 AND f_score = 1 THEN 'Recent Customers'
    WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
    WHEN r_score <= 2 AND f_score = 1 THEN 'Lost'
    WHEN r_score = 3 AND f_score = 1 THEN 'About to Sleep'
    ELSE 'Others' END AS rfm_segment
FROM rfm_scores_v
""",
    "m_dim_customers": """
SELECT a.*, coalesce(s.recency, -1) AS recency, coalesce(s.frequency, 0) AS frequency,
  coalesce(s.monetary, 0)::DECIMAL(37,2) AS monetary, coalesce(s.r_score, 0) AS r_score,
  coalesce(s.f_score, 0) AS f_score, coalesce(s.m_score, 0) AS m_score,
  coalesce(s.rfm_score, '000') AS rfm_score, coalesce(s.rfm_segment, 'Non-Active') AS rfm_segment
FROM (SELECT DISTINCT customer_unique_id, customer_city, customer_state FROM clean_customers) a
LEFT JOIN rfm_segments_v s ON s.customer_unique_id = a.customer_unique_id
""",
    "m_fact_orders": f"""
SELECT o.order_id, o.customer_id, c.customer_unique_id, o.order_status,
  (o.order_status = 'delivered')::INTEGER AS is_delivered,
  (o.order_status = 'canceled')::INTEGER AS is_canceled,
  o.order_purchase_timestamp, o.order_purchase_timestamp::DATE AS order_date,
  coalesce(r.order_revenue, 0)::DECIMAL(27,2) AS order_revenue, v.review_score,
  {DELIVERY},
  coalesce(p.order_total_payment_value, 0)::DECIMAL(26,2) AS order_total_payment_value,
  coalesce(p.payment_installments_max, 0) AS payment_installments_max,
  coalesce(p.payment_type_nunique, 0) AS payment_type_nunique
FROM clean_orders o
LEFT JOIN clean_customers c ON c.customer_id = o.customer_id
LEFT JOIN revenue_per_order r ON r.order_id = o.order_id
LEFT JOIN payments_per_order p ON p.order_id = o.order_id
LEFT JOIN reviews_per_order v ON v.order_id = o.order_id
""",
    "m_fact_sales": """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, c.customer_unique_id,
  o.order_purchase_timestamp::DATE AS order_date, i.price, i.freight_value,
  (i.price + i.freight_value)::DECIMAL(17,2) AS revenue
FROM clean_order_items i
JOIN clean_orders o ON o.order_id = i.order_id
JOIN clean_customers c ON c.customer_id = o.customer_id
""",
    "flat": f"""
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
  i.price, i.freight_value, i.price AS item_revenue, i.freight_value AS shipping_revenue,
  (i.price + i.freight_value)::DECIMAL(17,2) AS revenue, r.order_revenue,
  p.product_category_name,
  coalesce(t.product_category_name_english, 'unknown') AS product_category_name_english,
  (t.product_category_name_english IS NULL)::INTEGER AS missing_product_category_flag,
  s.seller_city, s.seller_state,
  o.customer_id, c.customer_unique_id, c.customer_city, c.customer_state,
  o.order_status, o.order_purchase_timestamp, o.order_delivered_customer_date,
  o.order_estimated_delivery_date,
  strftime(o.order_purchase_timestamp, '%Y-%m') AS order_month,
  year(o.order_purchase_timestamp)::INTEGER AS order_year,
  dayname(o.order_purchase_timestamp) AS order_weekday,
  hour(o.order_purchase_timestamp)::INTEGER AS purchase_hour,
  (o.order_status = 'delivered')::INTEGER AS is_delivered,
  {DELIVERY},
  {days("o.order_delivered_customer_date", "o.order_purchase_timestamp")} AS delivery_days,
  v.review_score, y.order_total_payment_value,
  (v.review_score IS NULL)::INTEGER AS missing_review_score_flag,
  (o.order_delivered_customer_date IS NULL)::INTEGER AS missing_delivery_info_flag,
  (o.order_status <> 'delivered' AND o.order_delivered_customer_date IS NOT NULL)::INTEGER
    AS order_status_delivery_conflict_flag
FROM clean_order_items i
LEFT JOIN clean_orders o ON o.order_id = i.order_id
LEFT JOIN clean_customers c ON c.customer_id = o.customer_id
LEFT JOIN clean_products p ON p.product_id = i.product_id
LEFT JOIN clean_category_translation t ON t.product_category_name = p.product_category_name
LEFT JOIN clean_sellers s ON s.seller_id = i.seller_id
LEFT JOIN payments_per_order y ON y.order_id = i.order_id
LEFT JOIN reviews_per_order v ON v.order_id = i.order_id
LEFT JOIN revenue_per_order r ON r.order_id = i.order_id
""",
    # Delivered orders as the item table shows them: attributes repeat within an order.
    "flat_orders": """
SELECT order_id, any_value(order_month) AS order_month, any_value(order_weekday) AS order_weekday,
  any_value(customer_unique_id) AS customer_unique_id, any_value(order_status) AS order_status,
  any_value(order_purchase_timestamp) AS order_purchase_timestamp,
  any_value(review_score) AS review_score, any_value(is_late_delivery) AS is_late_delivery,
  any_value(delivery_status) AS delivery_status,
  any_value(delivery_delay_days) AS delivery_delay_days, any_value(is_delivered) AS is_delivered,
  sum(revenue)::DECIMAL(26,2) AS order_revenue
FROM flat GROUP BY order_id
""",
    "mart_orders": """
SELECT order_id, strftime(order_date, '%Y-%m') AS order_month, dayname(order_date) AS order_weekday,
  customer_unique_id, order_status, is_delivered, order_revenue, review_score, is_late_delivery,
  delivery_status, delivery_delay_days
FROM m_fact_orders
""",
    "mart_sales": """
SELECT o.is_delivered,
  coalesce(p.product_category_name_english, 'unknown') AS product_category_name_english,
  s.revenue, s.order_id
FROM m_fact_sales s
JOIN m_fact_orders o ON o.order_id = s.order_id
LEFT JOIN m_dim_products p ON p.product_id = s.product_id
""",
    "sql_log": f"""
SELECT event_id AS log_id, user_id AS session_id,
  replace({STATEMENT_LIST}[event_id % {STATEMENT_COUNT} + 1], '{{n}}', (event_id % 97)::VARCHAR) AS sql
FROM events
""",
    "user_questions": "SELECT conv_id, turn, text FROM conversations WHERE role = 'user'",
}
