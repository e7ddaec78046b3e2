from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tests.helpers import items, orders, raw_table, rows, ts
from tradewind.functions.columns import iso_text, month_label, month_start, weekday_name
from tradewind.operators.dedup import dedup_keep_first
from tradewind.plans.cleaning import (
    clean_table,
    coerce_numeric,
    coerce_timestamp,
    fact_order_item_sales,
)
from tradewind.plans.staging import stage
from tradewind.schemas import ITEM_SALES, POSITION


def test_first_row_by_position_wins(spark):
    df = spark.createDataFrame(
        [("a", "late", 3), ("a", "first", 1), ("b", "only", 2), ("a", "middle", 2)],
        f"key string, value string, {POSITION} int",
    )
    assert sorted(rows(dedup_keep_first(df, ["key"]))) == [("a", "first"), ("b", "only")]


def test_null_keys_equal_each_other(spark):
    df = spark.createDataFrame(
        [(None, "x", 1), (None, "y", 2), ("a", "z", 3)], f"key string, value string, {POSITION} int"
    )
    assert sorted(rows(dedup_keep_first(df, ["key"])), key=str) == [("a", "z"), (None, "x")]


def test_without_position_the_order_is_total(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y")], "key string, n int, t string")
    assert rows(dedup_keep_first(df, ["key"])) == [("a", 1, "y")]


def test_numbers(spark):
    df = spark.createDataFrame(
        [(t,) for t in ("abc", "", "1e3", "12.345", None, " 7 ", "-1")], "price string"
    )
    got = [r[0] for r in rows(coerce_numeric(df, ["price", "no_such_column"]))]
    assert got == [None, None, Decimal("1000.00"), Decimal("12.35"), None, Decimal("7.00"), Decimal("-1.00")]


def test_times(spark):
    texts = ("2017-01-01 10:30:00", "2018-02-03 05:00:00", "not-a-date", "2017-01-01 10:30:00.9", None)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows(coerce_timestamp(df, ["t"]))]
    assert got == [ts("2017-01-01 10:30:00"), ts("2018-02-03 05:00:00"), None, ts("2017-01-01 10:30:00"), None]


def test_times_do_not_shift_at_clock_changes(spark):
    """00:30 does not exist in the session zone on that day; a zone-less time must keep it."""
    df = spark.createDataFrame([("2018-11-04 00:30:00",)], "t string")
    cleaned = coerce_timestamp(df, ["t"])
    assert rows(cleaned) == [(ts("2018-11-04 00:30:00"),)]
    assert rows(cleaned.select(iso_text(F.col("t")))) == [("2018-11-04 00:30:00",)]
    assert rows(cleaned.select(weekday_name(F.col("t")), month_label(F.col("t")), month_start(F.col("t")))) == [
        ("Sunday", "2018-11", ts("2018-11-01 00:00:00"))
    ]


def test_typed_times_lose_their_fraction(spark):
    df = orders(spark, [{"order_id": "o1", "order_purchase_timestamp": "2017-01-01 10:30:00.75"}])
    cleaned = clean_table("orders", df)
    assert cleaned.first()["order_purchase_timestamp"] == ts("2017-01-01 10:30:00")


def test_text_score_becomes_null(spark):
    df = spark.createDataFrame(
        [("r1", "o1", "five", None, None, None, None), ("r2", "o1", "5", None, None, None, None)],
        "review_id string, order_id string, review_score string, review_comment_title string,"
        " review_comment_message string, review_creation_date string, review_answer_timestamp string",
    )
    got = {r["review_id"]: r["review_score"] for r in clean_table("order_reviews", df).collect()}
    assert got == {"r1": None, "r2": 5}


def test_item_sales(spark):
    products = raw_table(spark, "products", [{"product_id": "p1", "product_category_name": "cat1"}, {"product_id": "p2"}])
    translation = raw_table(
        spark,
        "category_translation",
        [{"product_category_name": "cat1", "product_category_name_english": "electronics"}],
    )
    placed = orders(spark, [{"order_id": "o1", "order_purchase_timestamp": "2017-01-01 10:00:00"}])
    lines = items(
        spark,
        [("o1", 1, "p1", "s1", 100, 20), ("o1", 2, "p2", "s1", 1, None), ("o9", 1, "p9", "s1", 5, 1)],
    ).drop("revenue")
    fact = fact_order_item_sales(lines, placed, products, translation)
    assert fact.columns == ITEM_SALES.fieldNames()
    got = {(r.order_id, r.order_item_id): (r.product_category_name_english, r.revenue) for r in fact.collect()}
    assert got == {
        ("o1", 1): ("electronics", Decimal("120.00")),
        ("o1", 2): (None, None),
        ("o9", 1): (None, Decimal("6.00")),
    }


def test_staging_fixes_spelling_and_adds_revenue(spark):
    products = stage("products", raw_table(spark, "products", [{"product_id": "p"}]))
    assert {"product_name_length", "product_description_length"} <= set(products.columns)
    assert not [c for c in products.columns if "lenght" in c]
    staged = stage("order_items", items(spark, [("o", 1, "p", "s", 1, 2)]))
    assert staged.select(F.col("revenue").cast("string")).first()[0] == "3.00"
