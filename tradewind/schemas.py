"""Table layouts, cleaning rules and constraints of the marketplace model.

Everything below is declarative: the cleaning, quality and staging plans are generated from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Amounts up to 10^14, wider than the NUMERIC(12,2) of the declared model, and still one machine word.
# Sums take ten digits more, as Spark's decimal sums do, so a huge customer or category cannot overflow.
MONEY = T.DecimalType(16, 2)
ITEM_REVENUE = T.DecimalType(17, 2)
MONEY_SUM = T.DecimalType(26, 2)

# Column that carries the order in which rows were read, so "first row wins" is well defined.
POSITION = "_source_position"

_STR, _INT, _DBL, _TS, _DATE = (
    T.StringType(),
    T.IntegerType(),
    T.DoubleType(),
    T.TimestampNTZType(),
    T.DateType(),
)


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in cols])


RAW: dict[str, T.StructType] = {
    "customers": _struct(
        ("customer_id", _STR),
        ("customer_unique_id", _STR),
        ("customer_zip_code_prefix", _INT),
        ("customer_city", _STR),
        ("customer_state", _STR),
    ),
    "orders": _struct(
        ("order_id", _STR),
        ("customer_id", _STR),
        ("order_status", _STR),
        ("order_purchase_timestamp", _TS),
        ("order_approved_at", _TS),
        ("order_delivered_carrier_date", _TS),
        ("order_delivered_customer_date", _TS),
        ("order_estimated_delivery_date", _TS),
    ),
    "order_items": _struct(
        ("order_id", _STR),
        ("order_item_id", _INT),
        ("product_id", _STR),
        ("seller_id", _STR),
        ("shipping_limit_date", _TS),
        ("price", MONEY),
        ("freight_value", MONEY),
    ),
    "order_payments": _struct(
        ("order_id", _STR),
        ("payment_sequential", _INT),
        ("payment_type", _STR),
        ("payment_installments", _INT),
        ("payment_value", MONEY),
    ),
    "order_reviews": _struct(
        ("review_id", _STR),
        ("order_id", _STR),
        ("review_score", _DBL),
        ("review_comment_title", _STR),
        ("review_comment_message", _STR),
        ("review_creation_date", _TS),
        ("review_answer_timestamp", _TS),
    ),
    "products": _struct(
        ("product_id", _STR),
        ("product_category_name", _STR),
        ("product_name_lenght", _DBL),
        ("product_description_lenght", _DBL),
        ("product_photos_qty", _DBL),
        ("product_weight_g", _DBL),
        ("product_length_cm", _DBL),
        ("product_height_cm", _DBL),
        ("product_width_cm", _DBL),
    ),
    "sellers": _struct(
        ("seller_id", _STR),
        ("seller_zip_code_prefix", _INT),
        ("seller_city", _STR),
        ("seller_state", _STR),
    ),
    "category_translation": _struct(
        ("product_category_name", _STR),
        ("product_category_name_english", _STR),
    ),
}


@dataclass(frozen=True)
class TableRules:
    """Cleaning recipe and constraints of one raw table."""

    key: tuple[str, ...]
    money: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    ranges: tuple[tuple[str, int, int], ...] = ()
    # Free text may hold line breaks inside quotes; such files cannot be split while reading.
    multiline: bool = field(default=False)


RULES: dict[str, TableRules] = {
    "customers": TableRules(key=("customer_id",), required=("customer_id",)),
    "orders": TableRules(
        key=("order_id",),
        timestamps=tuple(f.name for f in RAW["orders"] if f.dataType == _TS),
        required=("order_id", "customer_id"),
    ),
    "order_items": TableRules(
        key=("order_id", "order_item_id"),
        money=("price", "freight_value"),
        timestamps=("shipping_limit_date",),
        required=("order_id", "order_item_id", "product_id", "seller_id"),
        non_negative=("price", "freight_value"),
    ),
    "order_payments": TableRules(
        key=("order_id", "payment_sequential"),
        money=("payment_value",),
        required=("order_id", "payment_sequential"),
        non_negative=("payment_value",),
    ),
    "order_reviews": TableRules(
        key=("review_id", "order_id"),
        timestamps=("review_creation_date", "review_answer_timestamp"),
        required=("review_id", "order_id"),
        ranges=(("review_score", 1, 5),),
        multiline=True,
    ),
    "products": TableRules(key=("product_id",), required=("product_id",)),
    "sellers": TableRules(key=("seller_id",), required=("seller_id",)),
    "category_translation": TableRules(
        key=("product_category_name",), required=("product_category_name",)
    ),
}

# child table, child column, parent table, parent column
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
)

ITEM_SALES = _struct(
    ("order_id", _STR),
    ("order_item_id", _INT),
    ("seller_id", _STR),
    ("product_id", _STR),
    ("product_category_name_english", _STR),
    ("order_purchase_timestamp", _TS),
    ("price", MONEY),
    ("freight_value", MONEY),
    ("revenue", ITEM_REVENUE),
)
ITEM_SALES_REQUIRED = (
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "price",
    "freight_value",
    "revenue",
)

# What each mart must expose, in this order. The names double as the allow-list of the SQL audit.
MARTS: dict[str, T.StructType] = {
    "dim_customers": _struct(
        ("customer_unique_id", _STR),
        ("customer_city", _STR),
        ("customer_state", _STR),
        ("recency", _DBL),
        ("frequency", T.LongType()),
        ("monetary", T.DecimalType(37, 2)),
        ("r_score", _INT),
        ("f_score", _INT),
        ("m_score", _INT),
        ("rfm_score", _STR),
        ("rfm_segment", _STR),
    ),
    "dim_products": _struct(
        ("product_id", _STR),
        ("product_category_name", _STR),
        ("product_category_name_english", _STR),
    ),
    "dim_sellers": _struct(("seller_id", _STR), ("seller_city", _STR), ("seller_state", _STR)),
    "dim_date": _struct(
        ("date", _DATE),
        ("year", _INT),
        ("month", _INT),
        ("quarter", _INT),
        ("day_of_week", _STR),
        ("is_weekend", _INT),
    ),
    "fact_orders": _struct(
        ("order_id", _STR),
        ("customer_id", _STR),
        ("customer_unique_id", _STR),
        ("order_status", _STR),
        ("is_delivered", _INT),
        ("is_canceled", _INT),
        ("order_purchase_timestamp", _TS),
        ("order_date", _DATE),
        ("order_revenue", T.DecimalType(27, 2)),
        ("review_score", _DBL),
        ("is_late_delivery", _INT),
        ("delivery_status", _STR),
        ("delivery_delay_days", _DBL),
        ("order_total_payment_value", MONEY_SUM),
        ("payment_installments_max", _INT),
        ("payment_type_nunique", T.LongType()),
    ),
    "fact_sales": _struct(
        ("order_id", _STR),
        ("order_item_id", _INT),
        ("product_id", _STR),
        ("seller_id", _STR),
        ("customer_unique_id", _STR),
        ("order_date", _DATE),
        ("price", MONEY),
        ("freight_value", MONEY),
        ("revenue", ITEM_REVENUE),
    ),
}

# Words a CSV reader of the pandas kind takes for a missing value.
NA_WORDS: tuple[str, ...] = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Name under which a cleaned table is stored, where it differs from the bundle name.
STORED_NAME = {"category_translation": "product_category_translation"}
