"""The declared model, spelled out for the statements: columns, keys, rules, mart types.

Nothing here is taken from the package, so a wrong key, edge or type there shows as a difference.
Fixed values: names, keys, rules and messages of the declared model. Types follow it except where
sums and counts are wider: amounts have 16 digits instead of 12, their sums 26 or more, and counts
are 64-bit.
"""

# Table: column and kind.
RAW: dict[str, list[tuple[str, str]]] = {
    "customers": [
        ("customer_id", "text"), ("customer_unique_id", "text"),
        ("customer_zip_code_prefix", "int"), ("customer_city", "text"), ("customer_state", "text"),
    ],
    "orders": [
        ("order_id", "text"), ("customer_id", "text"), ("order_status", "text"),
        ("order_purchase_timestamp", "time"), ("order_approved_at", "time"),
        ("order_delivered_carrier_date", "time"), ("order_delivered_customer_date", "time"),
        ("order_estimated_delivery_date", "time"),
    ],
    "order_items": [
        ("order_id", "text"), ("order_item_id", "int"), ("product_id", "text"), ("seller_id", "text"),
        ("shipping_limit_date", "time"), ("price", "money"), ("freight_value", "money"),
    ],
    "order_payments": [
        ("order_id", "text"), ("payment_sequential", "int"), ("payment_type", "text"),
        ("payment_installments", "int"), ("payment_value", "money"),
    ],
    "order_reviews": [
        ("review_id", "text"), ("order_id", "text"), ("review_score", "double"),
        ("review_comment_title", "text"), ("review_comment_message", "text"),
        ("review_creation_date", "time"), ("review_answer_timestamp", "time"),
    ],
    "products": [
        ("product_id", "text"), ("product_category_name", "text"), ("product_name_lenght", "double"),
        ("product_description_lenght", "double"), ("product_photos_qty", "double"),
        ("product_weight_g", "double"), ("product_length_cm", "double"),
        ("product_height_cm", "double"), ("product_width_cm", "double"),
    ],
    "sellers": [
        ("seller_id", "text"), ("seller_zip_code_prefix", "int"), ("seller_city", "text"),
        ("seller_state", "text"),
    ],
    "category_translation": [
        ("product_category_name", "text"), ("product_category_name_english", "text"),
    ],
}
ITEM_SALES = [
    ("order_id", "text"), ("order_item_id", "int"), ("seller_id", "text"), ("product_id", "text"),
    ("product_category_name_english", "text"), ("order_purchase_timestamp", "time"),
    ("price", "money"), ("freight_value", "money"), ("revenue", "money"),
]
STORED_NAME = {"category_translation": "product_category_translation"}

REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "orders": ("order_id", "customer_id"),
    "order_items": ("order_id", "order_item_id", "product_id", "seller_id"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("review_id", "order_id"),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "category_translation": ("product_category_name",),
}
KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("review_id", "order_id"),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "category_translation": ("product_category_name",),
}
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
)
NON_NEGATIVE: dict[str, tuple[str, ...]] = {
    "order_items": ("price", "freight_value"),
    "order_payments": ("payment_value",),
}
RANGES: tuple[tuple[str, str, int, int], ...] = (("order_reviews", "review_score", 1, 5),)

MARTS: dict[str, list[tuple[str, str]]] = {
    "dim_customers": [
        ("customer_unique_id", "string"), ("customer_city", "string"), ("customer_state", "string"),
        ("recency", "double"), ("frequency", "bigint"), ("monetary", "decimal(37,2)"),
        ("r_score", "int"), ("f_score", "int"), ("m_score", "int"), ("rfm_score", "string"),
        ("rfm_segment", "string"),
    ],
    "dim_products": [
        ("product_id", "string"), ("product_category_name", "string"),
        ("product_category_name_english", "string"),
    ],
    "dim_sellers": [("seller_id", "string"), ("seller_city", "string"), ("seller_state", "string")],
    "dim_date": [
        ("date", "date"), ("year", "int"), ("month", "int"), ("quarter", "int"),
        ("day_of_week", "string"), ("is_weekend", "int"),
    ],
    "fact_orders": [
        ("order_id", "string"), ("customer_id", "string"), ("customer_unique_id", "string"),
        ("order_status", "string"), ("is_delivered", "int"), ("is_canceled", "int"),
        ("order_purchase_timestamp", "timestamp_ntz"), ("order_date", "date"),
        ("order_revenue", "decimal(27,2)"), ("review_score", "double"), ("is_late_delivery", "int"),
        ("delivery_status", "string"), ("delivery_delay_days", "double"),
        ("order_total_payment_value", "decimal(26,2)"), ("payment_installments_max", "int"),
        ("payment_type_nunique", "bigint"),
    ],
    "fact_sales": [
        ("order_id", "string"), ("order_item_id", "int"), ("product_id", "string"),
        ("seller_id", "string"), ("customer_unique_id", "string"), ("order_date", "date"),
        ("price", "decimal(16,2)"), ("freight_value", "decimal(16,2)"), ("revenue", "decimal(17,2)"),
    ],
}


def columns(table: str) -> list[str]:
    return [name for name, _ in RAW[table]]
