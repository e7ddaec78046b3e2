from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tests.helpers import items, orders, raw_table, rows
from tradewind.operators import profiling, shaping


def test_overview_counts_repeated_rows(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 1), ("b", 1), ("a", None)], "k string, n int")
    assert rows(profiling.overview({"t": df})) == [("t", 5, 2, 2)]
    assert rows(profiling.overview({"t": df.limit(0)})) == [("t", 0, 2, 0)]


def test_missing_lists_only_gaps(spark):
    df = spark.createDataFrame([("a", None), ("b", None), (None, None)], "k string, n int")
    assert rows(profiling.missing({"t": df.selectExpr("k", "n", "1 as full")})) == [
        ("t", "n", 3, Decimal("100.00")),
        ("t", "k", 1, Decimal("33.33")),
    ]


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "v double")
    assert rows(profiling.missing({"t": df})) == [("t", "v", 2, Decimal("66.67"))]


def test_value_counts_skip_null(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    assert rows(profiling.value_counts(df, "k", "n")) == [("x", 2), ("y", 1)]


def test_scores_are_coerced(spark):
    df = spark.createDataFrame([("5",), ("5.0",), ("bad",), ("1",)], "review_score string")
    assert rows(profiling.score_counts(df)) == [(1.0, 1), (5.0, 2)]


def test_histogram(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 2, 3, 4, 5, 5, None)], "s int")
    got = profiling.histogram(df, "s").orderBy("bin").collect()
    assert [r.reviews for r in got] == [1, 2, 1, 1, 2]  # The maximum belongs to the last bin.
    assert (got[0].bin_start, got[-1].bin_end) == (1.0, 5.0)


def test_histogram_of_one_value_and_of_nothing(spark):
    one = spark.createDataFrame([(3,), (3,)], "s int")
    got = profiling.histogram(one, "s").orderBy("bin").collect()
    assert [r.reviews for r in got] == [0, 0, 2, 0, 0]
    assert (got[0].bin_start, got[-1].bin_end) == (2.5, 3.5)
    assert profiling.histogram(one.limit(0), "s").count() == 0


def test_join_sanity_finds_missing_partners(spark):
    lines = items(spark, [("a", 1, "p", "s", 1, 1), ("a", 2, "q", "s", 1, 1), ("z", 1, "p", "t", 1, 1)])
    got = dict(
        rows(
            profiling.join_sanity(
                lines,
                orders(spark, [{"order_id": "a", "customer_id": "nobody"}]),
                raw_table(spark, "customers", [{"customer_id": "c"}]),
                raw_table(spark, "products", [{"product_id": "p"}]),
                raw_table(spark, "sellers", [{"seller_id": "s"}]),
            )
        )
    )
    assert got == {
        "merged_rows": 3,
        "null_order_id": 0,
        "null_customer_id": 1,
        "null_product_id": 0,
        "null_seller_id": 0,
        "orders_not_found": 1,
        "customers_not_found": 3,
        "products_not_found": 1,
        "sellers_not_found": 1,
    }


def test_rollup_takes_the_first_known_value(spark):
    df = spark.createDataFrame(
        [("a", 3, 1), ("a", 1, None), ("a", 2, 4)], "order_id string, order_item_id int, review_score int"
    ).selectExpr("*", "1 as is_delivered", "0 as is_late_delivery", "cast(1 as decimal(13,2)) as revenue")
    got = profiling.order_level_rollup(df, ["review_score"]).first()
    assert (got.review_score, got.order_revenue) == (4, Decimal("3.00"))


def test_round_floats(spark):
    df = spark.createDataFrame([(100.555, 1, "x"), (200.7, 2, "y"), (0.125, 3, "z"), (None, 4, "")], "revenue double, n int, t string")
    assert [r[0] for r in rows(shaping.round_floats(df))] == [100.56, 200.7, 0.12, None]
    assert shaping.round_floats(df).dtypes == df.dtypes


def test_dates_by_name(spark):
    df = spark.createDataFrame(
        [(2017, 1, "2017-01-01", "2017-01-01", 1.5), (2018, 12, "2018-12-01", "soon", 2.5)],
        "year int, month int, order_date string, ship_time string, revenue double",
    )
    got = shaping.coerce_dates_by_name(df)
    assert dict(got.dtypes) == {
        "year": "int",
        "month": "int",
        "order_date": "timestamp_ntz",
        "ship_time": "string",  # One value does not parse, so the column stays as it is.
        "revenue": "double",
    }
    assert got.first().order_date == datetime(2017, 1, 1)


def test_summary_and_cap(spark):
    df = spark.range(1500).toDF("n")
    assert rows(shaping.result_summary(df)) == [(1500, 1, "n", False)]
    assert rows(shaping.result_summary(df.limit(0))) == [(0, 1, "n", True)]
    assert shaping.row_cap(df).count() == 1000


def test_capped_sql(spark):
    texts = ["select 1", " select 1 ;; ", "select 1 limit 5;", "select * from (select 1 Limit 2)", "select limits"]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    from pyspark.sql import functions as F

    assert [r[0] for r in rows(df.select(shaping.capped_sql(F.col("q"))))] == [
        "select 1 LIMIT 1000;",
        "select 1  LIMIT 1000;",
        "select 1 limit 5;",
        "select * from (select 1 Limit 2);",
        "select limits LIMIT 1000;",
    ]
