"""Report tables on the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.columns import (
    day_type,
    mean_days,
    mean_exact,
    month_label,
    weekday_name,
)
from tradewind.plans.kpis import (
    CATEGORY,
    avg_order_value,
    avg_review,
    item_performance,
    late_rate,
    money_total,
    performance,
    revenue_total,
    total_orders,
)


def read_orders(fact_orders: DataFrame, *more: str) -> DataFrame:
    """Order-level extract of the reports: the fact with month and weekday spelled out, and ``more`` columns."""
    return fact_orders.select(
        *more,
        "order_id",
        month_label(F.col("order_date")).alias("order_month"),
        weekday_name(F.col("order_date")).alias("order_weekday"),
        "customer_unique_id",
        "order_status",
        "is_delivered",
        "order_revenue",
        "review_score",
        "is_late_delivery",
        "delivery_status",
        "delivery_delay_days",
    )


def read_sales(fact_sales: DataFrame, fact_orders: DataFrame, products: DataFrame) -> DataFrame:
    """Item-level extract: sold items with delivery flag and category, 'unknown' where missing."""
    return (
        fact_sales.select("order_id", "product_id", "revenue")
        .join(products.select("product_id", CATEGORY), "product_id", "left")
        .join(fact_orders.select("order_id", "is_delivered"), "order_id")
        .select(
            "is_delivered",
            F.coalesce(CATEGORY, F.lit("unknown")).alias(CATEGORY),
            "revenue",
            "order_id",
        )
    )


def _delivered(orders: DataFrame, key: str | None = None) -> DataFrame:
    """Delivered rows; those without a value of the group key are left out of a report.

    The extract has one row per order, so orders are counted without a distinct.
    """
    rows = orders.where(F.col("is_delivered") == 1)
    return rows.where(F.col(key).isNotNull()) if key else rows


def growth_pct(value: Column, previous: Column) -> Column:
    """Change in percent; null for the first period and where the previous value is zero."""
    return F.try_divide((value - previous).cast("double"), previous.cast("double")) * 100


def monthly_kpi(orders: DataFrame) -> DataFrame:
    months = (
        _delivered(orders, "order_month")
        .groupBy("order_month")
        .agg(total_orders(), revenue_total(), avg_order_value(), avg_review(), late_rate())
    )
    # One row per month, so the window over all of them is small.
    previous = F.lag("total_revenue").over(Window.orderBy("order_month"))
    return months.withColumn(
        "mom_revenue_growth_pct", growth_pct(F.col("total_revenue"), previous)
    ).orderBy("order_month")


def top_categories(sales: DataFrame) -> DataFrame:
    return (
        item_performance(sales.where(F.col(CATEGORY).isNotNull()), CATEGORY)
        .orderBy(F.col("total_revenue").desc_nulls_last(), CATEGORY)
        .limit(10)
    )


def top_categories_of_marts(
    fact_sales: DataFrame, fact_orders: DataFrame, products: DataFrame
) -> DataFrame:
    """The same without the item-level extract: items are summed per order and category before they
    meet the orders, so an order with very many items is a few rows in that join."""
    sold = (
        fact_sales.select("order_id", "product_id", "revenue")
        .join(products.select("product_id", CATEGORY), "product_id", "left")
        .groupBy("order_id", F.coalesce(CATEGORY, F.lit("unknown")).alias(CATEGORY))
        .agg(F.sum("revenue").alias("revenue"), F.count("revenue").alias("items"))
    )
    done = _delivered(fact_orders).select("order_id")
    return (
        performance(sold.join(done, "order_id", "left_semi"), CATEGORY)
        .orderBy(F.col("total_revenue").desc_nulls_last(), CATEGORY)
        .limit(10)
    )


def delivery_review(orders: DataFrame) -> DataFrame:
    return (
        _delivered(orders, "delivery_status")
        .groupBy("delivery_status")
        .agg(
            total_orders(),
            avg_review(),
            mean_days(F.col("delivery_delay_days")).alias("avg_delivery_delay_days"),
            avg_order_value(),
        )
        .orderBy(F.col("total_orders").desc(), "delivery_status")
    )


def weekday_weekend(orders: DataFrame) -> DataFrame:
    return (
        _delivered(orders)
        .groupBy(day_type(F.col("order_weekday")).alias("day_type"))
        .agg(total_orders(), revenue_total(), avg_order_value(), avg_review())
    )


def customer_repeat(orders: DataFrame) -> DataFrame:
    customers = (
        _delivered(orders, "customer_unique_id")
        .groupBy("customer_unique_id")
        .agg(total_orders(), money_total("order_revenue").alias("total_revenue"))
    )
    kind = F.when(F.col("total_orders") > 1, "Repeat").otherwise("One-time")
    return customers.groupBy(kind.alias("customer_type")).agg(
        F.count("customer_unique_id").alias("total_customers"),
        mean_exact(F.col("total_revenue")).alias("avg_customer_revenue"),
    )


def summaries(
    fact_orders: DataFrame, fact_sales: DataFrame, products: DataFrame
) -> dict[str, DataFrame]:
    """All reports by the name of their file."""
    orders = read_orders(fact_orders)
    return {
        "monthly_kpi": monthly_kpi(orders),
        "top_categories_revenue": top_categories_of_marts(fact_sales, fact_orders, products),
        "delivery_review_analysis": delivery_review(orders),
        "weekday_vs_weekend": weekday_weekend(orders),
        "customer_repeat_proxy": customer_repeat(orders),
    }
