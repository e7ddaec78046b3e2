"""One order, product, seller and customer with a third of all rows each."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, final_plan
from tradewind.plans import kpis, marts, reports
from tradewind.plans.cleaning import fact_order_item_sales
from tradewind.schemas import RAW

N = 60000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
}


@pytest.fixture
def large_cluster(spark):
    """Thresholds scaled down with the data: nothing is broadcast and a hot partition counts."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key in SETTINGS:
        spark.conf.unset(key)


def hot(key: str, n: int):
    third = F.col("id") % 3 == 0
    return F.when(third, F.lit(f"{key}0")).otherwise(F.concat(F.lit(key), (F.col("id") % n).cast("string")))


@pytest.fixture
def tables(large_cluster, scratch):
    spark = large_cluster
    price = (F.col("id") % 100).cast("decimal(12,2)")
    lines = spark.range(0, N, 1, 8).select(
        hot("o", 4000).alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        hot("p", 500).alias("product_id"),
        hot("s", 200).alias("seller_id"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
        price.alias("price"),
        F.lit(1).cast("decimal(12,2)").alias("freight_value"),
        (price + 1).alias("revenue"),
        F.sha2(F.col("id").cast("string"), 256).alias("padding"),
    )
    k = F.col("id").cast("string")
    placed = spark.range(4000).select(
        F.concat(F.lit("o"), k).alias("order_id"),
        F.concat(F.lit("c"), k).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit("2017-01-01 10:00:00").cast("timestamp_ntz").alias("order_purchase_timestamp"),
        *(
            F.lit("2017-01-05 10:00:00").cast("timestamp_ntz").alias(c)
            for c in ("order_delivered_customer_date", "order_estimated_delivery_date")
        ),
    )
    people = spark.range(4000).select(
        F.concat(F.lit("c"), k).alias("customer_id"), hot("u", 900).alias("customer_unique_id")
    )
    goods = spark.range(500).select(
        F.concat(F.lit("p"), k).alias("product_id"),
        F.concat(F.lit("cat"), (F.col("id") % 5).cast("string")).alias("product_category_name"),
    )
    words = spark.range(5).select(
        F.concat(F.lit("cat"), k).alias("product_category_name"),
        F.concat(F.lit("word"), k).alias("product_category_name_english"),
    )
    named = {"lines": lines, "placed": placed, "people": people, "goods": goods, "words": words}
    for name, df in named.items():
        df.write.parquet(f"{scratch}/{name}")
    return {name: spark.read.parquet(f"{scratch}/{name}") for name in named}


def test_item_joins_split_the_hot_key(tables):
    t = tables
    sales = marts.fact_sales(t["lines"], t["placed"], t["people"])
    assert "skew=true" in final_plan(sales)
    assert sales.count() == N
    fact = fact_order_item_sales(t["lines"], t["placed"], t["goods"], t["words"])
    assert final_plan(fact).count("skew=true") >= 2  # The order join and the product join.
    assert fact.where("product_category_name_english is null").count() == 0
    assert fact.count() == N


def test_flat_items_split_the_hot_order(tables):
    t = tables
    spark = t["lines"].sparkSession
    payments = spark.createDataFrame([], RAW["order_payments"])
    reviews = spark.createDataFrame([], RAW["order_reviews"])
    sellers = spark.range(200).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("seller_id"),
        F.lit("x").alias("seller_city"),
        F.lit("y").alias("seller_state"),
    )
    people = t["people"].withColumns({"customer_city": F.lit("x"), "customer_state": F.lit("y")})
    attributes = marts.order_attributes(t["placed"], people, t["lines"], payments, reviews)
    flat = marts.flat_items(t["lines"], attributes, t["goods"], t["words"], sellers)
    joins = [line for line in final_plan(flat).splitlines() if "skew=true" in line]
    assert {k for k in ("order_id", "product_id", "seller_id") if any(f"[{k}#" in j for j in joins)} == {
        "order_id",
        "product_id",
        "seller_id",
    }
    assert flat.count() == N


def test_sums_shrink_the_hot_key_before_the_shuffle(tables, scratch):
    """A third of the rows in one product: the shuffle carries a row per key and task, not per item."""
    t = tables
    total = t["lines"].agg(F.sum("revenue")).first()[0]
    flat = t["lines"].withColumns(
        {"is_delivered": F.lit(1), "product_category_name_english": F.lit("one"), "order_month": F.lit("2017-01")}
    )
    got = kpis.category(flat).first()
    assert (got.total_revenue, got.total_orders) == (total, t["lines"].select("order_id").distinct().count())
    assert kpis.monthly_revenue(flat).first().total_revenue == total


def test_top_categories_of_marts_equals_extract(tables):
    t = tables
    sales = marts.fact_sales(t["lines"], t["placed"], t["people"])
    products = marts.dim_products(t["goods"], t["words"])
    facts = t["placed"].withColumn("is_delivered", F.lit(1))
    direct = reports.top_categories_of_marts(sales, facts, products)
    assert bag(direct) == bag(reports.top_categories(reports.read_sales(sales, facts, products)))


def test_segments_with_a_hot_customer(tables):
    t = tables
    base = marts.rfm_base(t["placed"], t["people"], t["lines"])
    assert base.agg(F.sum("frequency")).first()[0] == 4000
    assert marts.rfm_scores(base).count() == base.count()
