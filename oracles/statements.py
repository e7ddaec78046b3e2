"""One statement per registered query, over the shared views."""

from __future__ import annotations

from oracles.rules import (
    FOREIGN_KEYS,
    ITEM_SALES,
    KEYS,
    MARTS,
    NON_NEGATIVE,
    RANGES,
    RAW,
    REQUIRED,
    STORED_NAME,
    columns,
)
from oracles.views import DELIVERY, STATEMENT_COUNT, STATEMENT_LIST, VIEWS

ITEM_FACT = "fact_order_item_sales"
FACT_REQUIRED = (
    "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "revenue",
)


def mean(column: str) -> str:
    return f"sum({column})::DOUBLE / nullif(count({column}), 0)"


def mean_days(column: str) -> str:
    return f"sum({column}::DECIMAL(20,8))::DOUBLE / nullif(count({column}), 0)"


def half_up(expression: str, digits: int = 2) -> str:
    return f"round(({expression})::DECIMAL(30,10), {digits})::DECIMAL(22,{digits})"


def pct(part: str, whole: str) -> str:
    return half_up(f"({part})::DOUBLE * 100 / nullif(({whole})::DOUBLE, 0)")


def total(column: str) -> str:
    return f"sum({column})::DECIMAL(26,2)"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


S: dict[str, str] = {}

# --- sources and sinks ----------------------------------------------------------------------------

FORMS = {
    "text": "{0}",
    "int": "{0}::VARCHAR",
    "double": "floor({0} * 1e6::DOUBLE)::BIGINT::VARCHAR",  # In millionths.
    "money": "{0}::DECIMAL(26,2)::VARCHAR",
    "time": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
}


def as_text(label: str, name: str, fields: list[tuple[str, str]], relation: str) -> str:
    """Every row as one text of all its values, by column name."""
    texts = ", ".join(f"coalesce({FORMS[kind].format(c)}, '~')" for c, kind in sorted(fields))
    return f"SELECT '{name}' AS {label}, concat_ws('|', {texts}) AS fields FROM {relation}"


# What the files hold in place of the tables' values, as it is read back.
CSV_VALUES = {
    "order_items": """order_id::BIGINT % 7 AS seventh, * REPLACE (
  CASE WHEN order_id::BIGINT % 7 <> 0 THEN order_item_id END AS order_item_id,
  CASE WHEN order_id::BIGINT % 11 = 0 THEN 98765432109.87 ELSE price END AS price)""",
    "order_payments": """* REPLACE (
  CASE WHEN order_id::BIGINT % 13 <> 0 THEN payment_value END AS payment_value)""",
    "order_reviews": """* REPLACE (NULL::VARCHAR AS review_comment_title,
  review_comment_message || chr(10) || 'said "fine", twice' AS review_comment_message,
  CASE WHEN order_id::BIGINT % 17 = 0 THEN review_score + 0.9 ELSE review_score END AS review_score)""",
}
S["ingest_csv"] = union(
    [
        as_text("table_name", t, RAW[t], f"(SELECT {CSV_VALUES.get(t, '*')} FROM raw_{t})")
        for t in RAW
    ]
)
S["csv_unreadable"] = union(
    [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, ({count}) AS \"values\""
        for t, c, count in [
            (
                t,
                c,
                {
                    ("order_items", "order_item_id"): "SELECT count(*) FROM raw_order_items"
                    " WHERE order_id::BIGINT % 7 = 0",
                    ("order_payments", "payment_value"): "SELECT count(*) FROM raw_order_payments"
                    " WHERE order_id::BIGINT % 13 = 0",
                }.get((t, c), "0"),
            )
            for t in RAW
            for c in columns(t)
        ]
    ]
)
S["read_mart_orders"] = "SELECT * FROM mart_orders"
S["read_mart_sales"] = "SELECT * FROM mart_sales"
S["load_full_refresh"] = union(
    [as_text("table_name", STORED_NAME.get(t, t), RAW[t], f"clean_{t}") for t in RAW]
    + [as_text("table_name", ITEM_FACT, ITEM_SALES, "item_sales")]
)

# --- cleaning -------------------------------------------------------------------------------------

S["dedup_keep_first"] = "SELECT * FROM clean_order_items"
S["coerce_numeric"] = """
SELECT l_orderkey, l_linenumber, CASE l_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL
    WHEN 2 THEN (cents + 1) / 100::DECIMAL(16,2) ELSE price END::DECIMAL(16,2) AS price
FROM (SELECT *, l_extendedprice::DECIMAL(16,2) AS price,
        (l_extendedprice::DECIMAL(16,2) * 100)::BIGINT AS cents FROM lineitem)
"""
S["coerce_timestamp"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 1
    THEN o_orderdate::DATE + INTERVAL 630 MINUTE + to_seconds(o_orderkey % 60) END
  AS order_purchase_timestamp
FROM orders
"""
S[ITEM_FACT] = "SELECT * FROM item_sales"
for _t in RAW:
    S[f"clean_{_t}"] = f"SELECT * FROM clean_{_t}"
    S[f"stg_{STORED_NAME.get(_t, _t)}"] = f"SELECT * FROM clean_{_t}"
S["stg_order_items"] = """
SELECT *, (price + freight_value)::DECIMAL(17,2) AS revenue FROM clean_order_items
"""
S["stg_products"] = """
SELECT * EXCLUDE (product_name_lenght, product_description_lenght),
  product_name_lenght AS product_name_length,
  product_description_lenght AS product_description_length
FROM clean_products
"""

# --- data quality ---------------------------------------------------------------------------------


def check(order: int, name: str, table: str, columns: str, count: str, text: str) -> str:
    """One check: ``count`` is a scalar subquery, ``text`` the message with %s for the count."""
    message = text.replace("'", "''")
    return (
        f"SELECT {order} AS check_order, '{name}' AS check_name, '{table}' AS table_name,"
        f" '{columns}' AS column_names, v::BIGINT AS violations,"
        f" CASE WHEN v > 0 THEN replace('{message}', '%s', v::VARCHAR) END AS message"
        f" FROM (SELECT ({count}) AS v)"
    )


def source(table: str, state: str = "clean") -> str:
    """A table as cleaned, or with rows that break the rules."""
    if table == ITEM_FACT:
        return "item_sales" if state == "clean" else "broken_item_sales"
    return f"{state}_{table}"


def not_null(order: int, table: str, column: str) -> str:
    count = f"SELECT count(*) FROM {source(table, 'broken')} WHERE {column} IS NULL"
    return check(
        order, "not_null", table, column, count, f"{table}.{column} contains %s null values"
    )


def unique(order: int, table: str, key: tuple[str, ...], relation: str) -> str:
    names = ", ".join(key)
    count = f"SELECT (SELECT count(*) FROM {relation}) - count(*) FROM (SELECT DISTINCT {names} FROM {relation})"
    return check(
        order, "unique", table, names, count, f"{table} has %s duplicate rows on key [{names}]"
    )


def fk(order: int, child: str, column: str, parent: str, parent_column: str) -> str:
    count = (
        f"SELECT count(DISTINCT {column}) FROM broken_{child} c WHERE NOT EXISTS"
        f" (SELECT 1 FROM broken_{parent} p WHERE p.{parent_column} = c.{column})"
    )
    text = (
        f"Foreign key check failed: {child}.{column} -> {parent}.{parent_column}."
        " Missing references: %s"
    )
    return check(order, "fk", child, column, count, text)


def non_negative(order: int, table: str, column: str) -> str:
    count = f"SELECT count(*) FROM broken_{table} WHERE {column} < 0"
    return check(
        order, "non_negative", table, column, count, f"{table}.{column} contains %s negative values"
    )


def in_range(order: int, table: str, column: str, lo: int, hi: int) -> str:
    count = f"SELECT count(*) FROM broken_{table} WHERE {column} NOT BETWEEN {lo} AND {hi}"
    text = f"{table}.{column} contains %s values outside allowed range [{lo}, {hi}]"
    return check(order, "range", table, column, count, text)


def fact_timestamp(order: int) -> str:
    column = "order_purchase_timestamp"
    count = f"SELECT count(*) FROM broken_item_sales WHERE {column} IS NULL"
    text = f"{ITEM_FACT}.{column} contains null values after joins"
    return check(order, "fact_timestamp", ITEM_FACT, column, count, text)


S["check_not_null"] = union(
    [not_null(i, t, c) for t, required in REQUIRED.items() for i, c in enumerate(required)]
)
S["check_unique"] = union([unique(0, t, key, f"raw_{t}") for t, key in KEYS.items()])
S["check_fk"] = union([fk(0, *edge) for edge in FOREIGN_KEYS])
S["check_non_negative"] = union(
    [non_negative(i, t, c) for t, signed in NON_NEGATIVE.items() for i, c in enumerate(signed)]
)
S["check_range"] = union([in_range(0, *x) for x in RANGES])
S["check_fact_timestamp"] = fact_timestamp(0)


def _suite() -> str:
    makers = [(not_null, (t, c)) for t, required in REQUIRED.items() for c in required]
    makers += [(unique, (t, key, f"broken_{t}")) for t, key in KEYS.items()]
    makers += [(fk, edge) for edge in FOREIGN_KEYS]
    makers += [(non_negative, (t, c)) for t, signed in NON_NEGATIVE.items() for c in signed]
    makers += [(in_range, x) for x in RANGES]
    makers += [(not_null, (ITEM_FACT, c)) for c in FACT_REQUIRED]
    makers += [(fact_timestamp, ())]
    return union([make(i, *args) for i, (make, args) in enumerate(makers)])


S["validate_all"] = _suite()


def _report() -> str:
    def row(table: str, metric: str, column: str | None, value: str) -> str:
        name = f"'{column}'" if column else "NULL"
        return (
            f"SELECT '{table}' AS table_name, '{metric}' AS metric, {name}::VARCHAR AS column_name,"
            f" ({value})::BIGINT AS value"
        )

    def rows(relation: str) -> str:
        return f"(SELECT count(*) FROM {relation})"

    parts = []
    for t in RAW:
        parts += [
            row(t, "raw_row_counts", None, rows(f"raw_{t}")),
            row(t, "rows_removed_by_cleaning", None, f"{rows(f'raw_{t}')} - {rows(f'clean_{t}')}"),
        ]
    for t, fields in [*RAW.items(), (ITEM_FACT, ITEM_SALES)]:
        parts.append(row(t, "cleaned_row_counts", None, rows(source(t))))
        parts += [
            row(t, "null_counts", c, f"SELECT count(*) FROM {source(t)} WHERE {c} IS NULL")
            for c, _ in fields
        ]
    return union(parts)


S["quality_report"] = _report()
S["write_quality_report"] = _report()
S["schema_contract"] = union(
    [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name,"
        f" '{kind}' AS declared, '{kind}' AS actual,"
        f" count({c}) AS filled, 'ok' AS verdict FROM {'m_' + t if t != 'dim_sellers' else 'clean_sellers'}"
        for t, fields in MARTS.items()
        for c, kind in fields
    ]
)
S["delivery_conflict"] = """
SELECT order_id, order_status, order_delivered_customer_date,
  (order_status <> 'delivered' AND order_delivered_customer_date IS NOT NULL)::INTEGER
    AS order_status_delivery_conflict_flag
FROM clean_orders
"""

# --- marts ----------------------------------------------------------------------------------------

for _t in ("dim_date", "dim_products", "dim_customers", "fact_orders", "fact_sales"):
    S[_t] = f"SELECT * FROM m_{_t}"
S["dim_sellers"] = "SELECT seller_id, seller_city, seller_state FROM clean_sellers"
S["rfm_base"] = "SELECT * FROM rfm_base_v"
S["rfm_scores"] = "SELECT * FROM rfm_scores_v"
S["rfm_segments"] = "SELECT * FROM rfm_segments_v"
S["order_items_agg"] = "SELECT * FROM revenue_per_order"
S["payments_agg"] = "SELECT * FROM payments_per_order"
S["reviews_agg"] = "SELECT * FROM reviews_per_order"
S["delivery_metrics"] = f"SELECT order_id, {DELIVERY} FROM clean_orders"
S["flat_items"] = "SELECT * FROM flat"

# --- incremental load -----------------------------------------------------------------------------

S["incremental_filter"] = """
SELECT * FROM clean_orders
WHERE order_purchase_timestamp >=
  (SELECT max(order_purchase_timestamp) - INTERVAL 3 DAY FROM clean_orders)
"""


def _refreshed(fact: str, column: str, mark: str, outdated: str) -> str:
    """Rows of the old copy that lie before its lookback keep the outdated value."""
    return f"""
SELECT f.* REPLACE (
  CASE WHEN f.{column}::TIMESTAMP >= newest - INTERVAL 10 DAY AND f.{column}::TIMESTAMP < refreshed_from
       THEN {outdated} ELSE f.{mark} END AS {mark})
FROM {fact} f, (
  SELECT any_value(newest) AS newest, max({column}::TIMESTAMP) - INTERVAL 3 DAY AS refreshed_from
  FROM {fact}, (SELECT max({column}::TIMESTAMP) AS newest FROM {fact})
  WHERE {column}::TIMESTAMP < newest - INTERVAL 3 DAY)
"""


S["upsert_fact_orders"] = _refreshed(
    "m_fact_orders", "order_purchase_timestamp", "delivery_status", "'outdated'"
)
S["upsert_fact_sales"] = _refreshed("m_fact_sales", "order_date", "price", "-1::DECIMAL(16,2)")

# --- KPIs on the flat items -----------------------------------------------------------------------

ORDERS = "count(*) AS total_orders"
REVENUE = f"{total('order_revenue')} AS total_revenue"
AOV = f"{mean('order_revenue')} AS avg_order_value"
REVIEW = f"{mean('review_score')} AS avg_review_score"
LATE = f"{mean('is_late_delivery')} AS late_delivery_rate"
DAY_TYPE = "CASE WHEN order_weekday IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END"
CATEGORY = "product_category_name_english"
ITEMS = (
    f"{total('revenue')} AS total_revenue, count(DISTINCT order_id) AS total_orders,"
    f" {mean('revenue')} AS avg_item_revenue"
)
GROWTH = "(total_revenue - previous)::DOUBLE / nullif(previous::DOUBLE, 0) * 100"


def by(key: str, figures: str, relation: str, rest: str = "") -> str:
    return (
        f"SELECT {key}, {figures} FROM {relation} WHERE is_delivered = 1 GROUP BY ALL {rest}"
    )


def monthly_growth(relation: str) -> str:
    months = by("order_month", f"{ORDERS}, {REVENUE}, {AOV}, {REVIEW}, {LATE}", relation)
    return f"""
SELECT * EXCLUDE (previous), {GROWTH} AS mom_revenue_growth_pct
FROM (SELECT *, lag(total_revenue) OVER (ORDER BY order_month) AS previous FROM ({months}))
"""


def repeat(relation: str) -> str:
    return f"""
SELECT CASE WHEN total_orders > 1 THEN 'Repeat' ELSE 'One-time' END AS customer_type,
  count(*) AS total_customers, {mean('total_revenue')} AS avg_customer_revenue
FROM ({by('customer_unique_id', f'{ORDERS}, {REVENUE}', relation)})
WHERE customer_unique_id IS NOT NULL
GROUP BY ALL
"""


S["kpi_monthly_revenue"] = by("order_month", f"{ORDERS}, {REVENUE}, {AOV}", "flat_orders")
S["kpi_monthly"] = by(
    "order_month", f"{ORDERS}, {REVENUE}, {AOV}, {REVIEW}, {LATE}", "flat_orders"
)
S["kpi_category"] = by(CATEGORY, ITEMS, "flat")
S["kpi_customer_summary"] = by("customer_unique_id", f"{ORDERS}, {REVENUE}, {AOV}", "flat_orders")
S["kpi_review_delivery"] = by(
    "delivery_status",
    f"{ORDERS}, {REVIEW}, {mean_days('delivery_delay_days')} AS avg_delay_days, {AOV}",
    "flat_orders",
)
S["kpi_weekday_weekend"] = by(
    f"{DAY_TYPE} AS day_type", f"{ORDERS}, {REVENUE}, {AOV}, {REVIEW}", "flat_orders"
)
S["kpi_seller"] = by("seller_id", ITEMS, "flat")
S["kpi_pareto_category"] = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (ORDER BY total_revenue DESC NULLS FIRST, {CATEGORY})::INTEGER AS rn,
    count(*) OVER () AS total_categories
  FROM ({by(CATEGORY, f"{total('revenue')} AS total_revenue", "flat")}))
WHERE rn <= ceil(0.2 * total_categories)
"""
S["kpi_total_revenue"] = f"SELECT {total('revenue')} AS total_revenue FROM flat WHERE is_delivered = 1"
S["kpi_top10_category"] = by(
    CATEGORY,
    f"{total('revenue')} AS total_revenue",
    "flat",
    f"ORDER BY total_revenue DESC NULLS FIRST, {CATEGORY} LIMIT 10",
)
S["kpi_retention"] = f"""
SELECT customer_type, total_customers,
  {pct('total_customers', 'sum(total_customers) OVER ()')} AS customer_share_pct
FROM (SELECT CASE WHEN n = 1 THEN 'One-time Customers' ELSE 'Repeat Customers' END AS customer_type,
        count(*) AS total_customers
      FROM ({by('customer_unique_id', 'count(*) AS n', 'flat_orders')}) GROUP BY ALL)
"""
S["kpi_late_impact"] = by(
    "CASE WHEN is_late_delivery = 1 THEN 'Late' WHEN delivery_delay_days IS NOT NULL"
    " THEN 'On Time / Early' ELSE 'Unknown' END AS delivery_bucket",
    f"{ORDERS}, {half_up(mean('review_score'))} AS avg_review_score,"
    f" {half_up(mean('order_revenue'))} AS avg_order_value",
    "flat_orders",
)

# --- reports --------------------------------------------------------------------------------------


def reports(orders: str, items: str) -> dict[str, str]:
    return {
        "monthly_kpi": monthly_growth(orders),
        "top_categories": by(
            CATEGORY, ITEMS, items, f"ORDER BY total_revenue DESC NULLS LAST, {CATEGORY} LIMIT 10"
        ),
        "delivery_review": by(
            "delivery_status",
            f"{ORDERS}, {REVIEW}, {mean_days('delivery_delay_days')} AS avg_delivery_delay_days, {AOV}",
            orders,
        ),
        "weekday_weekend": by(
            f"{DAY_TYPE} AS day_type", f"{ORDERS}, {REVENUE}, {AOV}, {REVIEW}", orders
        ),
        "customer_repeat": repeat(orders),
    }


_reports = reports("mart_orders", "mart_sales")
S |= {f"report_{k}": v for k, v in _reports.items()}
S |= {f"profile_{k}": v for k, v in reports("flat_orders", "flat").items()}

# The order fact of a stream is that of a refresh; reports of partial sums are those of the refreshed fact.
S["feed_fact_orders"] = S["upsert_fact_orders"]
_upserted = VIEWS["mart_orders"].replace("m_fact_orders", f"({S['upsert_fact_orders']})")
S |= {
    f"kept_{k}": reports(f"({_upserted})", "")[k]
    for k in ("monthly_kpi", "delivery_review", "weekday_weekend")
}

_FIGURES = {
    "total_orders": "int",
    "total_customers": "int",
    "total_revenue": "money",
}
_FILES = {
    "monthly_kpi": (
        "monthly_kpi",
        "order_month total_orders total_revenue avg_order_value avg_review_score"
        " late_delivery_rate mom_revenue_growth_pct",
    ),
    "top_categories_revenue": (
        "top_categories", f"{CATEGORY} total_revenue total_orders avg_item_revenue",
    ),
    "delivery_review_analysis": (
        "delivery_review",
        "delivery_status total_orders avg_review_score avg_delivery_delay_days avg_order_value",
    ),
    "weekday_vs_weekend": (
        "weekday_weekend", "day_type total_orders total_revenue avg_order_value avg_review_score",
    ),
    "customer_repeat_proxy": (
        "customer_repeat", "customer_type total_customers avg_customer_revenue",
    ),
}


def _summary(name: str, report: str, names: str) -> str:
    label, *figures = names.split()
    fields = [(label, "text")] + [(c, _FIGURES.get(c, "double")) for c in figures]
    return as_text("summary", name, fields, f"({_reports[report]})")


S["write_summary_csv"] = union([_summary(name, *parts) for name, parts in _FILES.items()])

# --- ad-hoc queries and example questions ---------------------------------------------------------

S["adhoc_monthly_price_revenue"] = f"""
SELECT date_trunc('month', o.order_purchase_timestamp) AS month, {total('i.price')} AS revenue
FROM clean_orders o JOIN clean_order_items i ON i.order_id = o.order_id GROUP BY ALL
"""
S["adhoc_top_categories"] = f"""
SELECT t.{CATEGORY} AS category, {total('i.price')} AS revenue
FROM clean_order_items i
JOIN clean_products p ON p.product_id = i.product_id
LEFT JOIN clean_category_translation t ON t.product_category_name = p.product_category_name
GROUP BY ALL ORDER BY revenue DESC NULLS FIRST, category ASC NULLS LAST LIMIT 10
"""
S["adhoc_customers_by_state"] = """
SELECT customer_state, count(*) AS customer_count FROM clean_customers GROUP BY ALL
"""
S["bench_raw_category_revenue"] = f"""
SELECT t.{CATEGORY}, {total('i.price + i.freight_value')} AS revenue
FROM clean_orders o
JOIN clean_order_items i ON i.order_id = o.order_id
JOIN clean_products p ON p.product_id = i.product_id
JOIN clean_category_translation t ON t.product_category_name = p.product_category_name
GROUP BY ALL
"""
S["bench_star_category_revenue"] = f"""
SELECT {CATEGORY}, {total('revenue')} AS revenue FROM item_sales GROUP BY ALL
"""
S["ask_monthly_revenue"] = f"""
SELECT date_trunc('month', order_date::TIMESTAMP) AS month,
  {total('order_revenue')} AS total_revenue
FROM m_fact_orders GROUP BY ALL
"""
S["ask_category_revenue"] = f"""
SELECT p.{CATEGORY}, {total('s.revenue')} AS total_revenue
FROM m_fact_sales s JOIN m_dim_products p ON p.product_id = s.product_id GROUP BY ALL
"""
S["ask_payment_types"] = """
SELECT payment_type, count(*) AS payment_count FROM clean_order_payments GROUP BY ALL
"""
S["ask_customers_by_state"] = """
SELECT customer_state, count(DISTINCT customer_unique_id) AS customer_count
FROM m_dim_customers GROUP BY ALL
"""
S["ask_avg_freight_per_order_month"] = f"""
SELECT month, {mean('freight')} AS avg_freight_per_order
FROM (SELECT date_trunc('month', o.order_date::TIMESTAMP) AS month, o.order_id,
        sum(s.freight_value) AS freight
      FROM m_fact_sales s JOIN m_fact_orders o ON o.order_id = s.order_id GROUP BY ALL)
GROUP BY month
"""
S["ask_review_by_delivery_status"] = f"""
SELECT delivery_status, {REVIEW} FROM m_fact_orders GROUP BY ALL
"""
S["ask_top_sellers"] = f"""
SELECT d.seller_id, d.seller_city, d.seller_state, {total('s.revenue')} AS total_revenue
FROM m_fact_sales s JOIN clean_sellers d ON d.seller_id = s.seller_id
GROUP BY ALL ORDER BY total_revenue DESC NULLS FIRST, d.seller_id LIMIT 10
"""
S["ask_total_fact_item_revenue"] = f"SELECT {total('revenue')} AS total_revenue FROM item_sales"
S["ask_segment_counts"] = """
SELECT rfm_segment, count(DISTINCT customer_unique_id) AS customer_count
FROM m_dim_customers GROUP BY ALL
"""
S["ask_payment_profile"] = f"""
SELECT payment_type_nunique, count(*) AS orders,
  {total('order_total_payment_value')} AS total_payment_value,
  {mean('order_total_payment_value')} AS avg_payment_value,
  {mean('payment_installments_max')} AS avg_installments_max,
  max(payment_installments_max) AS max_installments
FROM m_fact_orders GROUP BY ALL
"""

# --- profiling and shaping ------------------------------------------------------------------------


def raw(table: str) -> str:
    return f"(SELECT {', '.join(columns(table))} FROM raw_{table})"


S["profile_overview"] = union(
    [
        f"SELECT '{t}' AS dataset, count(*) AS rows, {len(RAW[t])} AS columns,"
        f" count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {raw(t)})) AS duplicates"
        f" FROM raw_{t}"
        for t in RAW
    ]
)
S["profile_missing"] = (
    f"SELECT dataset, \"column\", missing_count, {pct('missing_count', 'rows')} AS missing_pct FROM ("
    + union(
        [
            f"SELECT '{t}' AS dataset, '{c}' AS \"column\", count(*) AS rows,"
            f" count(*) - count({c}) AS missing_count FROM raw_{t}"
            for t in RAW
            for c in columns(t)
        ]
    )
    + ") WHERE missing_count > 0"
)
S["profile_order_status"] = """
SELECT order_status, count(*) AS orders FROM raw_orders
WHERE order_status IS NOT NULL GROUP BY ALL
"""
S["profile_review_scores"] = """
SELECT review_score::DOUBLE AS review_score, count(*) AS reviews FROM raw_order_reviews
WHERE review_score IS NOT NULL GROUP BY ALL
"""
S["profile_review_histogram"] = """
SELECT bin, lo + bin * width AS bin_start, lo + (bin + 1) * width AS bin_end,
  (SELECT count(*) FROM raw_order_reviews
   WHERE least(floor((review_score - lo) / width), 4) = bin) AS reviews
FROM (SELECT min(review_score)::DOUBLE AS lo,
        (max(review_score) - min(review_score))::DOUBLE / 5 AS width FROM raw_order_reviews)
CROSS JOIN (VALUES (0), (1), (2), (3), (4)) b(bin)
"""
S["profile_payment_types"] = """
SELECT payment_type, count(*) AS payments FROM raw_order_payments
WHERE payment_type IS NOT NULL GROUP BY ALL
"""
S["profile_untranslated"] = f"""
SELECT count(*) AS total_products, count(*) - count({CATEGORY}) AS untranslated,
  {pct(f'count(*) - count({CATEGORY})', 'count(*)')} AS untranslated_pct
FROM raw_products p
LEFT JOIN raw_category_translation t ON t.product_category_name = p.product_category_name
"""
S["profile_join_sanity"] = """
UNPIVOT (
  SELECT count(*) AS merged_rows,
    count(*) FILTER (i.order_id IS NULL) AS null_order_id,
    count(*) FILTER (o.customer_id IS NULL) AS null_customer_id,
    count(*) FILTER (i.product_id IS NULL) AS null_product_id,
    count(*) FILTER (i.seller_id IS NULL) AS null_seller_id,
    count(*) FILTER (o.order_id IS NULL) AS orders_not_found,
    count(*) FILTER (c.customer_id IS NULL) AS customers_not_found,
    count(*) FILTER (p.product_id IS NULL) AS products_not_found,
    count(*) FILTER (s.seller_id IS NULL) AS sellers_not_found
  FROM raw_order_items i
  LEFT JOIN raw_orders o ON o.order_id = i.order_id
  LEFT JOIN raw_customers c ON c.customer_id = o.customer_id
  LEFT JOIN raw_products p ON p.product_id = i.product_id
  LEFT JOIN raw_sellers s ON s.seller_id = i.seller_id
) ON * INTO NAME metric VALUE value
"""
S["profile_grain"] = f"""
SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_orders,
  count(DISTINCT customer_unique_id) AS unique_customers,
  {half_up('count(*)::DOUBLE / count(DISTINCT order_id)')} AS avg_rows_per_order
FROM flat
"""
S["order_level_rollup"] = "SELECT * FROM flat_orders"
S["headline_kpis"] = f"""
SELECT count(*) AS delivered_orders, {total('order_revenue')} AS delivered_revenue,
  {half_up(mean('order_revenue'))} AS avg_order_value,
  {half_up(mean('review_score'), 4)} AS avg_review_score,
  {half_up(mean('is_late_delivery'), 4)} AS late_delivery_rate,
  (SELECT {half_up('(count(*) - count(review_score))::DOUBLE / count(*)', 4)} FROM flat)
    AS missing_review_rate
FROM flat_orders WHERE is_delivered = 1
"""
S["grain_bias"] = union(
    [
        f"SELECT '{metric}' AS metric, (SELECT {mean(column)} FROM flat) AS item_level,"
        f" (SELECT {mean(column)} FROM flat_orders WHERE is_delivered = 1)"
        " AS order_level_delivered"
        for metric, column in (
            ("avg_review_score", "review_score"),
            ("late_delivery_rate", "is_late_delivery"),
        )
    ]
)
S["round_floats"] = """
SELECT * REPLACE (round_even(delivery_delay_days * 100.0::DOUBLE, 0) / 100.0::DOUBLE
  AS delivery_delay_days) FROM mart_orders
"""
S["coerce_dates_by_name"] = """
SELECT o_orderkey, CASE kind WHEN 0 THEN 'not-a-date' WHEN 1 THEN NULL
    ELSE strftime(moment, '%Y-%m-%d %H:%M:%S') || CASE kind WHEN 2 THEN '.75' ELSE '' END END AS mixed_time,
  CASE kind WHEN 0 THEN TIMESTAMP '1995-01-01' WHEN 1 THEN NULL
    WHEN 2 THEN moment + INTERVAL 750 MILLISECOND ELSE moment END AS order_date,
  o_orderkey % 12 + 1 AS month
FROM (SELECT o_orderkey, o_orderkey % 7 AS kind,
        o_orderdate::DATE + INTERVAL 630 MINUTE + to_seconds(o_orderkey % 60) AS moment FROM orders)
"""
S["result_summary"] = """
SELECT count(*) AS row_count, 11 AS column_count,
  'order_id,order_month,order_weekday,customer_unique_id,order_status,is_delivered,order_revenue,review_score,is_late_delivery,delivery_status,delivery_delay_days' AS columns,
  count(*) = 0 AS is_empty
FROM mart_orders
"""
S["row_cap"] = """
SELECT order_id, order_item_id, revenue FROM m_fact_sales
ORDER BY order_id, order_item_id LIMIT 1000
"""

# --- text and vectors -----------------------------------------------------------------------------

# Word characters in the Unicode sense; RE2 knows no look-around, so a neighbour is consumed.
EDGE = r"[^\p{L}\p{N}_]"


def word(text: str, words: str, flags: str = "i") -> str:
    return f"regexp_matches({text}, '(^|{EDGE})({words})({EDGE}|$)', '{flags}')"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^[\s\v\p{{Z}}]+|[\s\v\p{{Z}}]+$', '', 'g')"


TABLES = (
    rf"regexp_extract_all(sql, '(?:^|{EDGE})(?:from|join)\s+(?:[a-zA-Z0-9_]+\.)?([a-zA-Z_][a-zA-Z0-9_]*)',"
    " 1, 'i')"
)
CTES = (
    rf"regexp_extract_all(sql, '(?:(?:^|{EDGE})with\s+|,\s*)([a-zA-Z_][a-zA-Z0-9_]*)\s+as\s*\(',"
    " 1, 'i')"
)
# What a statement may not contain.
FORBIDDEN_WORDS = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "DROP",
    "ALTER",
    "TRUNCATE",
    "CREATE",
    "GRANT",
    "REVOKE",
)
SYSTEM_NAMES = (
    "information_schema",
    "pg_catalog",
    "pg_tables",
    "pg_class",
    "pg_attribute",
    "pg_indexes",
)
ALLOWED = "[" + ", ".join(f"'{t}'" for t in MARTS) + "]"
# The messages of the guard.
AUDIT = rf"""
SELECT * EXCLUDE (text, one, tables, ctes, base, strangers), message = 'SQL is valid.' AS is_valid
FROM (
  SELECT *, CASE
    WHEN text = '' THEN 'SQL is empty.'
    WHEN contains(one, ';') THEN 'Multiple SQL statements are not allowed.'
    WHEN NOT regexp_matches(text, '^(select|with)', 'i') THEN 'Only SELECT queries are allowed.'
    WHEN {word('text', '|'.join(FORBIDDEN_WORDS))}
      THEN 'SQL contains forbidden keywords.'
    WHEN {word('text', f'select({EDGE}|{EDGE}.*{EDGE})into', 'is')} THEN 'SELECT INTO is not allowed.'
    WHEN {word('text', '|'.join(SYSTEM_NAMES))}
      THEN 'Access to system tables is not allowed.'
    WHEN len(tables) = 0 THEN 'SQL must reference at least one allowed table.'
    WHEN len(strangers) > 0 THEN 'Table ''' || strangers[1] || ''' is not allowed.'
    WHEN len(base) = 0 THEN 'SQL must reference at least one allowed base table.'
    ELSE 'SQL is valid.' END AS message
  FROM (SELECT *, list_filter(base, lambda t: NOT list_contains({ALLOWED}, lower(t))) AS strangers
  FROM (SELECT *, list_filter(tables, lambda t: NOT list_contains(ctes, lower(t))) AS base
  FROM (SELECT *, {strip('sql')} AS text,
          {strip("regexp_replace(" + strip('sql') + ", ';$', '')")} AS one,
          {TABLES} AS tables,
          list_transform({CTES}, lambda t: lower(t)) AS ctes
        FROM __log__)))
)
"""
S["audit_sql_log"] = AUDIT.replace("__log__", "sql_log")
S["row_cap_sql"] = rf"""
SELECT log_id, bare || CASE WHEN {word('bare', 'limit')} THEN ';' ELSE ' LIMIT 1000;' END AS sql
FROM (SELECT log_id, regexp_replace({strip('sql')}, ';+$', '') AS bare FROM sql_log)
"""
S["extract_table_refs"] = f"""
SELECT table_name, count(*) AS "references"
FROM (SELECT unnest({TABLES}) AS table_name FROM sql_log) GROUP BY ALL
"""
S["extract_cte_names"] = f"""
SELECT cte_name, count(*) AS statements
FROM (SELECT unnest(list_distinct(list_transform({CTES}, lambda t: lower(t)))) AS cte_name
      FROM sql_log)
GROUP BY ALL
"""
# What a question may not ask for.
FORBIDDEN_REQUESTS = (
    "delete",
    "drop",
    "truncate",
    "update",
    "insert",
    "alter",
    "remove",
    "modify",
    "create table",
    "delete all rows",
    "write sql that deletes",
)
S["audit_questions"] = rf"""
SELECT *, message = 'Question is valid.' AS is_valid FROM (
  SELECT *, CASE WHEN {strip('text')} = '' THEN 'Please enter a business analytics question.'
    WHEN {word('text', '|'.join(FORBIDDEN_REQUESTS))}
    THEN 'This application only supports read-only analytics questions. Requests that modify or delete data are not allowed.'
    ELSE 'Question is valid.' END AS message
  FROM user_questions)
"""
# The statement inside the fence, worked out from how the answers are made.
S["strip_fences"] = f"SELECT log_id, {strip('sql')} AS sql FROM sql_log"
S["question_key"] = f"""
SELECT conv_id, turn, sha256(lower({strip('text')})) AS question_key FROM user_questions
"""
S["semantic_lookup"] = f"""
SELECT q.query_id, CASE WHEN b.cache_id IS NULL THEN 'miss' ELSE 'hit' END AS verdict, b.cache_id,
  round(b.distance, 6) AS distance, round(1 - b.distance, 6) AS similarity,
  {STATEMENT_LIST}[b.cache_id % {STATEMENT_COUNT} + 1] AS sql
FROM (SELECT vec_id AS query_id FROM embeddings) q
LEFT JOIN (
  SELECT query_id, arg_min(cache_id, (distance, cache_id)) AS cache_id, min(distance) AS distance
  FROM (
    SELECT query_id, c.vec_id AS cache_id,
      round(1 - list_cosine_similarity(v, c.embedding::DOUBLE[]), 9) AS distance
    FROM (SELECT vec_id AS query_id, CASE WHEN vec_id % 2 = 0
            THEN list_transform(embedding, lambda x, i:
                   CASE WHEN i % 2 = 1 THEN (x::DOUBLE * 1.1)::FLOAT ELSE x END)
            ELSE list_reverse(embedding) END::DOUBLE[] AS v
          FROM embeddings), embeddings c)
  WHERE distance < 0.10 GROUP BY query_id) b
  ON b.query_id = q.query_id
"""
S["semantic_lookup_blocks"] = S["semantic_lookup"]
# All elements, in millionths.
VECTOR = """array_to_string(
      list_transform(embedding, lambda x: floor(x::DOUBLE * 1e6)::BIGINT::VARCHAR), ',')"""
S["semantic_upsert"] = f"""
WITH stored AS (
  SELECT 'question ' || vec_id AS question, {STATEMENT_LIST}[vec_id % {STATEMENT_COUNT} + 1] AS sql,
    {VECTOR} AS vector
  FROM embeddings),
offered AS (
  SELECT vec_id AS position, CASE WHEN vec_id % 3 = 0 THEN ' Question ' || (vec_id // 2)
      ELSE 'follow-up ' || (vec_id // 4) END AS question,
    {STATEMENT_LIST}[(vec_id + 1) % {STATEMENT_COUNT} + 1] AS sql, {VECTOR} AS vector
  FROM embeddings),
fresh AS (
  SELECT DISTINCT ON (id) * EXCLUDE (position) FROM (
    SELECT sha256(lower(trim(question))) AS id, position, question, sql, vector
    FROM ({AUDIT.replace("__log__", "offered")}) WHERE is_valid)
  ORDER BY id, position DESC)
SELECT * FROM fresh
UNION ALL
SELECT sha256(question) AS id, question, sql, vector FROM stored
WHERE sha256(question) NOT IN (SELECT id FROM fresh)
"""
S["recent_questions"] = """
SELECT * FROM (
  SELECT user_id, event_type, last_asked,
    row_number() OVER (PARTITION BY user_id ORDER BY last_asked DESC, event_type)::INTEGER AS position
  FROM (SELECT user_id, event_type, max(ts) AS last_asked FROM events GROUP BY ALL))
WHERE position <= 5
"""

STATEMENTS = S
