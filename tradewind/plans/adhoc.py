"""Ad-hoc queries on staged tables and marts.

Where only sums are asked for, items are summed per product or order before they meet the lookup
table: a best-selling product is then one row per task in the shuffle and in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.columns import mean_exact, month_start
from tradewind.plans.kpis import CATEGORY, money_total


def revenue() -> Column:
    return money_total("amount").alias("revenue")


def monthly_price_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Price without freight per purchase month, all statuses."""
    per_order = items.groupBy("order_id").agg(F.sum("price").alias("amount"))
    return (
        orders.select("order_id", "order_purchase_timestamp")
        .join(per_order, "order_id")
        .groupBy(month_start(F.col("order_purchase_timestamp")).alias("month"))
        .agg(revenue())
        .orderBy("month")
    )


def top_categories(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Ten categories with the highest price total; untranslated products form one null group."""
    return (
        items.groupBy("product_id")
        .agg(F.sum("price").alias("amount"))
        .join(products.select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("amount").alias("amount"))
        .join(translation, "product_category_name", "left")
        .groupBy(F.col(CATEGORY).alias("category"))
        .agg(revenue())
        .orderBy(F.col("revenue").desc_nulls_first(), F.col("category").asc_nulls_last())
        .limit(10)
    )


def customers_by_state(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("customer_state")
        .agg(F.count("*").alias("customer_count"))
        .orderBy(F.col("customer_count").desc(), "customer_state")
    )


def raw_category_revenue(
    orders: DataFrame, items: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    """Category revenue from the normalized tables; only items that find all partners count.

    Orders only filter here, and their key is unique, so a semi join keeps their columns out. What
    is left is summed per product and per category before each further lookup.
    """
    return (
        items.join(orders.select("order_id"), "order_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum(F.col("price") + F.col("freight_value")).alias("amount"))
        .join(products.select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("amount").alias("amount"))
        .join(translation, "product_category_name")
        .groupBy(CATEGORY)
        .agg(revenue())
    )


def star_category_revenue(item_sales: DataFrame) -> DataFrame:
    """The same from the pre-joined item fact, where untranslated products stay as a null group."""
    return item_sales.groupBy(CATEGORY).agg(money_total("revenue").alias("revenue"))


# --- the example questions ------------------------------------------------------------------------


def ask_monthly_revenue(fact_orders: DataFrame) -> DataFrame:
    return (
        fact_orders.groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(money_total("order_revenue").alias("total_revenue"))
        .orderBy("month")
    )


def ask_category_revenue(fact_sales: DataFrame, products: DataFrame) -> DataFrame:
    return (
        fact_sales.groupBy("product_id")
        .agg(F.sum("revenue").alias("amount"))
        .join(products, "product_id")
        .groupBy(CATEGORY)
        .agg(money_total("amount").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc_nulls_first(), CATEGORY)
    )


def ask_payment_types(payments: DataFrame) -> DataFrame:
    return (
        payments.groupBy("payment_type")
        .agg(F.count("*").alias("payment_count"))
        .orderBy(F.col("payment_count").desc(), "payment_type")
    )


def ask_customers_by_state(dim_customers: DataFrame) -> DataFrame:
    return (
        dim_customers.groupBy("customer_state")
        .agg(F.count_distinct("customer_unique_id").alias("customer_count"))
        .orderBy(F.col("customer_count").desc(), "customer_state")
    )


def ask_avg_freight_per_order_month(fact_sales: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Freight of an order, averaged over the orders of a month."""
    freight = fact_sales.groupBy("order_id").agg(F.sum("freight_value").alias("freight"))
    return (
        fact_orders.select("order_id", "order_date")
        .join(freight, "order_id")
        .groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(mean_exact(F.col("freight")).alias("avg_freight_per_order"))
        .orderBy("month")
    )


def ask_review_by_delivery_status(fact_orders: DataFrame) -> DataFrame:
    return (
        fact_orders.groupBy("delivery_status")
        .agg(mean_exact(F.col("review_score")).alias("avg_review_score"))
        .orderBy("delivery_status")
    )


def ask_top_sellers(fact_sales: DataFrame, sellers: DataFrame, n: int = 10) -> DataFrame:
    return (
        fact_sales.groupBy("seller_id")
        .agg(money_total("revenue").alias("total_revenue"))
        .join(sellers, "seller_id")
        .select("seller_id", "seller_city", "seller_state", "total_revenue")
        .orderBy(F.col("total_revenue").desc_nulls_first(), "seller_id")
        .limit(n)
    )


def ask_total_fact_item_revenue(item_sales: DataFrame) -> DataFrame:
    return item_sales.agg(money_total("revenue").alias("total_revenue"))


def ask_segment_counts(dim_customers: DataFrame) -> DataFrame:
    return (
        dim_customers.groupBy("rfm_segment")
        .agg(F.count_distinct("customer_unique_id").alias("customer_count"))
        .orderBy(F.col("customer_count").desc(), "rfm_segment")
    )


def ask_payment_profile(fact_orders: DataFrame) -> DataFrame:
    """Orders, mean payment and longest instalment plan per number of payment types used."""
    return (
        fact_orders.groupBy("payment_type_nunique")
        .agg(
            F.count("*").alias("orders"),
            money_total("order_total_payment_value").alias("total_payment_value"),
            mean_exact(F.col("order_total_payment_value")).alias("avg_payment_value"),
            mean_exact(F.col("payment_installments_max")).alias("avg_installments_max"),
            F.max("payment_installments_max").alias("max_installments"),
        )
        .orderBy("payment_type_nunique")
    )
