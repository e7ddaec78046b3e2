from __future__ import annotations

from decimal import Decimal

import pytest

from tradewind.plans import kpis, reports

FLAT = (
    "order_id string, order_month string, order_weekday string, customer_unique_id string,"
    " is_delivered int, is_late_delivery int, delivery_status string, delivery_delay_days double,"
    " review_score int, revenue decimal(13,2), product_category_name_english string, seller_id string"
)


def item(order, revenue, month="2017-01", weekday="Monday", customer="u1", delivered=1, late=0,
         status="on_time_or_early", delay=-1.0, review=5, category="toys", seller="s1"):
    return (order, month, weekday, customer, delivered, late, status, delay, review,
            None if revenue is None else Decimal(revenue), category, seller)


def flat(spark, *rows):
    return spark.createDataFrame(list(rows), FLAT)


@pytest.mark.parametrize("categories,kept", [(1, 1), (5, 1), (6, 2), (10, 2), (11, 3)])
def test_pareto_rounds_up(spark, categories, kept):
    df = flat(spark, *(item(f"o{i}", 100 - i, category=f"c{i:02}") for i in range(categories)))
    got = kpis.pareto_category(df).collect()
    assert [r.rn for r in sorted(got, key=lambda r: r.rn)] == list(range(1, kept + 1))
    assert {r.total_categories for r in got} == {categories}


def test_order_means_are_not_weighted_by_items(spark):
    df = flat(spark, item("a", 10, review=1), item("a", 20, review=1), item("a", 30, review=1), item("b", 40, review=5))
    row = kpis.monthly(df).first()
    assert (row.total_orders, row.total_revenue, row.avg_order_value, row.avg_review_score) == (
        2, Decimal("100.00"), 50.0, 3.0)


def test_only_delivered_orders_count(spark):
    df = flat(spark, item("a", 10), item("b", 99, delivered=0))
    assert kpis.total_revenue(df).first().total_revenue == Decimal("10.00")
    assert kpis.monthly_revenue(df).first().total_orders == 1


def test_means_without_values_are_null(spark):
    row = kpis.monthly(flat(spark, item("a", 10, review=None))).first()
    assert row.avg_review_score is None and row.late_delivery_rate == 0.0


def test_category_counts_orders_once(spark):
    df = flat(spark, item("a", 10), item("a", 20), item("b", None), item("c", 5, category="books"))
    got = {r.product_category_name_english: tuple(r)[1:] for r in kpis.category(df).collect()}
    # A missing revenue counts as an order but not in the mean.
    assert got == {"toys": (Decimal("30.00"), 2, 15.0), "books": (Decimal("5.00"), 1, 5.0)}


def test_late_buckets(spark):
    df = flat(
        spark,
        item("a", 1, late=1, delay=2.0),
        item("b", 2),
        item("c", 4, delay=None),
        item("c", 5, delay=None),
    )
    got = {r.delivery_bucket: (r.total_orders, r.avg_order_value) for r in kpis.late_impact(df).collect()}
    assert got == {
        "Late": (1, Decimal("1.00")),
        "On Time / Early": (1, Decimal("2.00")),
        "Unknown": (1, Decimal("9.00")),
    }


def test_retention_shares(spark):
    df = flat(spark, item("a", 1), item("b", 1), item("c", 1, customer="u2"), item("d", 1, customer="u3"))
    got = {r.customer_type: (r.total_customers, r.customer_share_pct) for r in kpis.retention(df).collect()}
    assert got == {"One-time Customers": (2, Decimal("66.67")), "Repeat Customers": (1, Decimal("33.33"))}


def test_growth_is_null_for_first_month_and_after_zero(spark):
    df = spark.createDataFrame(
        [("a", "2017-01", 1, Decimal(0), None, 0), ("b", "2017-02", 1, Decimal(50), 4, 1), ("c", "2017-03", 1, Decimal(75), 5, 0)],
        "order_id string, order_month string, is_delivered int, order_revenue decimal(23,2), review_score int, is_late_delivery int",
    )
    assert [r.mom_revenue_growth_pct for r in reports.monthly_kpi(df).collect()] == [None, None, 50.0]


def test_no_rows(spark):
    empty = flat(spark)
    assert kpis.monthly(empty).count() == 0
    assert kpis.total_revenue(empty).first().total_revenue is None
    assert kpis.pareto_category(empty).count() == 0
