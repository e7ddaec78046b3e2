"""KPI queries on the flat item table.

Order KPIs keep the items of delivered orders, roll them up to orders and then group by the KPI key.
Both steps aggregate inside the tasks before the shuffle, so neither a huge order nor a frequent KPI
key gathers rows in one place. Windows and sorts only see the small aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.columns import (
    day_type,
    flag,
    mean_days,
    mean_exact,
    round_half_up,
    share_pct,
)
from tradewind.schemas import MONEY_SUM

CATEGORY = "product_category_name_english"


def money_total(name: str) -> Column:
    return F.sum(name).cast(MONEY_SUM)


def delivered_orders(flat: DataFrame, *keys: str, **extra: Column) -> DataFrame:
    """Delivered orders with their revenue; ``keys`` repeat on the items of an order.

    So does ``is_delivered``, which comes from the order, so the filter reaches the scan.
    """
    return (
        delivered_items(flat)
        .groupBy("order_id", *keys)
        .agg(F.sum("revenue").alias("order_revenue"), *(c.alias(n) for n, c in extra.items()))
    )


def delivered_items(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("is_delivered") == 1)


def total_orders() -> Column:
    return F.count("order_id").alias("total_orders")


def avg_order_value() -> Column:
    return mean_exact(F.col("order_revenue")).alias("avg_order_value")


def avg_review() -> Column:
    return mean_exact(F.col("review_score")).alias("avg_review_score")


def late_rate() -> Column:
    return mean_exact(F.col("is_late_delivery")).alias("late_delivery_rate")


def revenue_total() -> Column:
    return money_total("order_revenue").alias("total_revenue")


def monthly_revenue(flat: DataFrame) -> DataFrame:
    return (
        delivered_orders(flat, "order_month")
        .groupBy("order_month")
        .agg(total_orders(), revenue_total(), avg_order_value())
        .orderBy("order_month")
    )


def monthly(flat: DataFrame) -> DataFrame:
    late = F.max("is_late_delivery")
    return (
        delivered_orders(flat, "order_month", review_score=F.max("review_score"), is_late_delivery=late)
        .groupBy("order_month")
        .agg(total_orders(), revenue_total(), avg_order_value(), avg_review(), late_rate())
        .orderBy("order_month")
    )


def performance(per_order: DataFrame, key: str) -> DataFrame:
    """Revenue, orders and mean item revenue per key, from (key, order, revenue, items) rows."""
    return (
        per_order.groupBy(key)
        .agg(
            money_total("revenue").alias("total_revenue"),
            F.count("order_id").alias("total_orders"),
            F.try_divide(F.sum("revenue").cast("double"), F.sum("items")).alias("avg_item_revenue"),
        )
        .select(key, "total_revenue", "total_orders", "avg_item_revenue")
    )


def item_performance(flat: DataFrame, key: str) -> DataFrame:
    """Delivered items first summed per (key, order).

    That spreads a frequent key over the tasks and turns the distinct count of orders into a plain
    count.
    """
    per_order = (
        delivered_items(flat)
        .groupBy(key, "order_id")
        .agg(F.sum("revenue").alias("revenue"), F.count("revenue").alias("items"))
    )
    return performance(per_order, key)


def category(flat: DataFrame) -> DataFrame:
    return item_performance(flat, CATEGORY).orderBy(
        F.col("total_revenue").desc_nulls_first(), CATEGORY
    )


def customer_summary(flat: DataFrame) -> DataFrame:
    return (
        delivered_orders(flat, "customer_unique_id")
        .groupBy("customer_unique_id")
        .agg(total_orders(), revenue_total(), avg_order_value())
    )


def review_delivery(flat: DataFrame) -> DataFrame:
    orders = delivered_orders(
        flat,
        "delivery_status",  # As a key; the maximum of a text would need a sort of all items.
        review_score=F.max("review_score"),
        delivery_delay_days=F.max("delivery_delay_days"),
    )
    return (
        orders.groupBy("delivery_status")
        .agg(
            total_orders(),
            avg_review(),
            mean_days(F.col("delivery_delay_days")).alias("avg_delay_days"),
            avg_order_value(),
        )
        .orderBy(F.col("total_orders").desc(), "delivery_status")
    )


def weekday_weekend(flat: DataFrame) -> DataFrame:
    return (
        delivered_orders(flat, "order_weekday", review_score=F.max("review_score"))
        .groupBy(day_type(F.col("order_weekday")).alias("day_type"))
        .agg(total_orders(), revenue_total(), avg_order_value(), avg_review())
    )


def seller(flat: DataFrame) -> DataFrame:
    return (
        item_performance(flat, "seller_id")
        .select("seller_id", "total_orders", "total_revenue", "avg_item_revenue")
        .orderBy(F.col("total_revenue").desc_nulls_first(), "seller_id")
    )


def category_revenue(flat: DataFrame) -> DataFrame:
    return (
        delivered_items(flat).groupBy(CATEGORY).agg(money_total("revenue").alias("total_revenue"))
    )


def pareto_category(flat: DataFrame) -> DataFrame:
    """The best-selling fifth of the categories, rounded up; equal revenue is ordered by name."""
    best = Window.orderBy(F.col("total_revenue").desc_nulls_first(), F.col(CATEGORY))
    return (
        category_revenue(flat)
        .withColumn("rn", F.row_number().over(best))
        .withColumn("total_categories", F.count("*").over(Window.partitionBy()))
        .where(F.col("rn") <= F.ceil(F.col("total_categories") / 5))
    )


def total_revenue(flat: DataFrame) -> DataFrame:
    return delivered_items(flat).agg(money_total("revenue").alias("total_revenue"))


def top10_category(flat: DataFrame) -> DataFrame:
    return (
        category_revenue(flat)
        .orderBy(F.col("total_revenue").desc_nulls_first(), CATEGORY)
        .limit(10)
    )


def retention(flat: DataFrame) -> DataFrame:
    per_customer = (
        delivered_orders(flat, "customer_unique_id")
        .groupBy("customer_unique_id")
        .agg(F.count("order_id").alias("orders"))
    )
    kind = F.when(F.col("orders") == 1, "One-time Customers").otherwise("Repeat Customers")
    everyone = F.sum("total_customers").over(Window.partitionBy())
    return (
        per_customer.groupBy(kind.alias("customer_type"))
        .agg(F.count("*").alias("total_customers"))
        .withColumn("customer_share_pct", share_pct(F.col("total_customers"), everyone))
        .orderBy(F.col("total_customers").desc(), "customer_type")
    )


def late_impact(flat: DataFrame) -> DataFrame:
    orders = delivered_orders(
        flat,
        is_late_delivery=F.max("is_late_delivery"),
        review_score=F.max("review_score"),
        has_delay=F.max(flag(F.col("delivery_delay_days").isNotNull())),
    )
    bucket = (
        F.when(F.col("is_late_delivery") == 1, "Late")
        .when(F.col("has_delay") == 1, "On Time / Early")
        .otherwise("Unknown")
    )
    return (
        orders.groupBy(bucket.alias("delivery_bucket"))
        .agg(
            total_orders(),
            round_half_up(mean_exact(F.col("review_score"))).alias("avg_review_score"),
            round_half_up(mean_exact(F.col("order_revenue"))).alias("avg_order_value"),
        )
        .orderBy(F.col("total_orders").desc(), "delivery_bucket")
    )
