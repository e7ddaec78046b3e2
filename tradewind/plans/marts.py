"""Star schema: dimensions, facts and the flat item table, built from staged tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.columns import days_between, flag, month_label, weekday_name
from tradewind.operators.ranking import global_ntile
from tradewind.schemas import MARTS


def delivered() -> Column:
    return F.col("order_status") == "delivered"


def late() -> Column:
    return F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")


def arrived() -> Column:
    return F.col("order_delivered_customer_date").isNotNull()


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


# --- dimensions -----------------------------------------------------------------------------------


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day from the first to the last purchase; empty without purchases."""
    day = F.col("date")
    bounds = orders.agg(
        F.min("order_purchase_timestamp").cast("date").alias("lo"),
        F.max("order_purchase_timestamp").cast("date").alias("hi"),
    )
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date")).select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        weekday_name(day).alias("day_of_week"),
        flag(F.weekday(day) >= 5).alias("is_weekend"),
    )


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    return products.join(translation, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", F.lit("unknown")).alias(
            "product_category_name_english"
        ),
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(*MARTS["dim_sellers"].fieldNames())


# --- customer segments ----------------------------------------------------------------------------


def rfm_base(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value per customer with a delivered order.

    Items are summed per order before they meet the orders, so a large order is one row in the join.
    Orders are joined to revenue last: the partitioning by order then serves the distinct count, and
    the sum per customer starts inside the same tasks. The newest purchase of all is a scalar subquery.
    """
    people = customers.select("customer_id", "customer_unique_id")
    newest = orders.agg(F.max("order_purchase_timestamp").alias("newest")).scalar()
    per_customer = (
        orders.where(delivered())
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(people, "customer_id")
        .join(order_items_agg(items), "order_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            F.max("order_purchase_timestamp").alias("last_purchase"),
            F.count_distinct("order_id").alias("frequency"),
            F.sum(or_zero("order_revenue")).alias("monetary"),
        )
    )
    return per_customer.withColumn("newest", newest).select(
        "customer_unique_id",
        days_between(F.col("newest"), F.col("last_purchase")).alias("recency"),
        "frequency",
        "monetary",
    )


def rfm_scores(base: DataFrame) -> DataFrame:
    """Five score classes each; the customer id breaks ties, missing values sort as the largest."""
    tie = F.col("customer_unique_id").asc_nulls_last()
    by_recency = global_ntile(base, 5, [F.col("recency").desc_nulls_first(), tie], "r_score")
    scored = global_ntile(by_recency, 5, [F.col("monetary").asc_nulls_last(), tie], "m_score")
    f_score = F.when(F.col("frequency") == 1, 1).when(F.col("frequency") == 2, 3).otherwise(5)
    return scored.withColumn("f_score", f_score).select(
        *base.columns,
        "r_score",
        "f_score",
        "m_score",
        F.concat(*(F.col(c).cast("string") for c in ("r_score", "f_score", "m_score"))).alias(
            "rfm_score"
        ),
    )


def rfm_segments(scores: DataFrame) -> DataFrame:
    r, f = F.col("r_score"), F.col("f_score")
    # Segment names, first match wins.
    segment = (
        F.when((r >= 4) & (f >= 3), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f == 1), "Recent Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f == 1), "Lost")
        .when((r == 3) & (f == 1), "About to Sleep")
        .otherwise("Others")
    )
    return scores.withColumn("rfm_segment", segment)


def dim_customers(customers: DataFrame, segments: DataFrame) -> DataFrame:
    """Every (customer, city, state) once, with the segment of the customer.

    A customer seen in two cities keeps two rows, so counts of customers must be distinct.
    """
    places = customers.select("customer_unique_id", "customer_city", "customer_state").distinct()
    # What a customer without a delivered order gets.
    absent = {
        "recency": -1.0,
        "frequency": 0,
        "monetary": 0,
        "r_score": 0,
        "f_score": 0,
        "m_score": 0,
        "rfm_score": "000",
        "rfm_segment": "Non-Active",
    }
    return places.join(segments, "customer_unique_id", "left").select(
        *places.columns,
        *(
            F.coalesce(F.col(c), F.lit(v)).cast(MARTS["dim_customers"][c].dataType).alias(c)
            for c, v in absent.items()
        ),
    )


# --- order-level aggregates -----------------------------------------------------------------------


def order_items_agg(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum("revenue").alias("order_revenue"))


def payments_agg(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.max("payment_installments").alias("payment_installments_max"),
        F.count_distinct("payment_type").alias("payment_type_nunique"),
        F.sum("payment_value").alias("order_total_payment_value"),
    )


def reviews_agg(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(F.max("review_score").alias("review_score"))


def delivery_columns() -> dict[str, Column]:
    """Lateness of an order. An unknown status counts as neither late nor undelivered."""
    # The words of the delivery status.
    return {
        "is_late_delivery": flag(delivered() & late()),
        "delivery_status": F.when(~delivered(), "not_delivered")
        .when(late(), "late")
        .otherwise("on_time_or_early"),
        "delivery_delay_days": days_between(
            F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
        ),
    }


def delivery_metrics(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", *(c.alias(n) for n, c in delivery_columns().items()))


# --- facts ----------------------------------------------------------------------------------------


def fact_orders(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """One row per order."""
    return fact_orders_from_totals(
        orders, customers, order_items_agg(items), payments_agg(payments), reviews_agg(reviews)
    )


def fact_orders_from_totals(
    orders: DataFrame,
    customers: DataFrame,
    item_totals: DataFrame,
    payment_totals: DataFrame,
    review_scores: DataFrame,
) -> DataFrame:
    """One row per order, from the detail tables aggregated per order.

    Each join is one row to at most one row, and all but the customer join share the partitioning
    the aggregates already have.
    """
    joined = (
        orders.join(customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
        .join(item_totals, "order_id", "left")
        .join(payment_totals, "order_id", "left")
        .join(review_scores, "order_id", "left")
    )
    zeros = (
        "order_revenue",
        "order_total_payment_value",
        "payment_installments_max",
        "payment_type_nunique",
    )
    return joined.withColumns(
        {
            "is_delivered": flag(delivered()),
            "is_canceled": flag(F.col("order_status") == "canceled"),
            "order_date": F.col("order_purchase_timestamp").cast("date"),
            **delivery_columns(),
            **{c: or_zero(c) for c in zeros},
        }
    ).select(*MARTS["fact_orders"].fieldNames())


def sales_source(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Items with the customer and the purchase time of their order; unmatched items drop out.

    Orders find their customer first, which is a join of order-sized tables. The items, the largest
    table, are shuffled only once, and adaptive execution can split an order with very many items.
    """
    placed = orders.select("order_id", "customer_id", "order_purchase_timestamp").join(
        customers.select("customer_id", "customer_unique_id"), "customer_id"
    )
    return items.join(placed, "order_id").withColumn(
        "order_date", F.col("order_purchase_timestamp").cast("date")
    )


def fact_sales(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    return sales_source(items, orders, customers).select(*MARTS["fact_sales"].fieldNames())


# --- flat item table ------------------------------------------------------------------------------


def conflict() -> Column:
    """1 where the status says undelivered but a delivery time is recorded."""
    return flag(~delivered() & arrived())


def order_features() -> dict[str, Column]:
    """Derived after the join, so the shuffle carries only what they are derived from."""
    return {
        "is_delivered": flag(delivered()),
        **delivery_columns(),
        "delivery_days": days_between(
            F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp")
        ),
        "order_month": month_label(F.col("order_purchase_timestamp")),
        "order_year": F.year("order_purchase_timestamp"),
        "order_weekday": weekday_name(F.col("order_purchase_timestamp")),
        "purchase_hour": F.hour("order_purchase_timestamp"),
        "missing_review_score_flag": flag(F.col("review_score").isNull()),
        "missing_delivery_info_flag": flag(~arrived()),
        "order_status_delivery_conflict_flag": conflict(),
    }


FLAT_COLUMNS: tuple[str, ...] = (
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "shipping_limit_date",
    "price",
    "freight_value",
    "item_revenue",
    "shipping_revenue",
    "revenue",
    "order_revenue",
    "product_category_name",
    "product_category_name_english",
    "missing_product_category_flag",
    "seller_city",
    "seller_state",
    "customer_id",
    "customer_unique_id",
    "customer_city",
    "customer_state",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "order_month",
    "order_year",
    "order_weekday",
    "purchase_hour",
    "is_delivered",
    "is_late_delivery",
    "delivery_status",
    "delivery_days",
    "delivery_delay_days",
    "review_score",
    "order_total_payment_value",
    "missing_review_score_flag",
    "missing_delivery_info_flag",
    "order_status_delivery_conflict_flag",
)


def order_attributes(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """What the flat table repeats on each item of an order; one row per order.

    Customers are joined last: the result is then not partitioned by order, so the join with the
    items has a shuffle on both sides, which adaptive execution needs to split an order with very
    many items.
    """
    paid = payments_agg(payments).select("order_id", "order_total_payment_value")
    people = customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )
    return (
        orders.join(paid, "order_id", "left")
        .join(reviews_agg(reviews), "order_id", "left")
        .join(order_items_agg(items), "order_id", "left")
        .join(people, "customer_id", "left")
    )


def flat_items(
    items: DataFrame,
    attributes: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    sellers: DataFrame,
    columns: Sequence[str] = FLAT_COLUMNS,
) -> DataFrame:
    """One row per item with the attributes of its order, product and seller.

    Every lookup is a left join on a unique key and adds no rows, so with fewer ``columns`` the
    joins nobody reads from are left out. Columns made of others come last, so no shuffle carries them;
    so does the revenue of ``items`` without that column.
    """
    made = {"item_revenue": F.col("price"), "shipping_revenue": F.col("freight_value")}
    if "revenue" not in items.columns:
        made["revenue"] = F.col("price") + F.col("freight_value")
    flat = items
    if set(columns) & {
        "product_category_name",
        "product_category_name_english",
        "missing_product_category_flag",
    }:
        categories = products.select("product_id", "product_category_name").join(
            translation, "product_category_name", "left"
        )
        flat = flat.join(categories, "product_id", "left")
        english = F.col("product_category_name_english")
        made |= {
            "missing_product_category_flag": flag(english.isNull()),
            "product_category_name_english": F.coalesce(english, F.lit("unknown")),
        }
    if set(columns) & {"seller_city", "seller_state"}:
        flat = flat.join(
            sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "left"
        )
    features = order_features()
    if set(columns) & {*attributes.columns, *features} - {"order_id"}:
        flat = flat.join(attributes, "order_id", "left")
        made |= features
    return flat.withColumns(made).select(*columns)


def delivery_conflict(orders: DataFrame) -> DataFrame:
    """Orders flagged where the status says undelivered but a delivery time is recorded."""
    return orders.select(
        "order_id",
        "order_status",
        "order_delivered_customer_date",
        conflict().alias("order_status_delivery_conflict_flag"),
    )
