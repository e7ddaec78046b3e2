from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from tests.helpers import items, money, orders, raw_table
from tradewind.plans import marts


def customers(spark, *people):
    return raw_table(
        spark,
        "customers",
        [
            {"customer_id": i, "customer_unique_id": u, "customer_city": c, "customer_state": "X"}
            for i, u, c in people
        ],
    )


def delivered(order_id, day, customer=None):
    return {
        "order_id": order_id,
        "customer_id": customer or order_id,
        "order_status": "delivered",
        "order_purchase_timestamp": day,
    }


def test_dim_date_single_day(spark):
    one = orders(spark, [delivered("a", "2017-12-31 23:59:59")])
    assert [tuple(r) for r in marts.dim_date(one).collect()] == [
        (date(2017, 12, 31), 2017, 12, 4, "Sunday", 1)
    ]


def test_dim_date_without_orders(spark):
    assert marts.dim_date(orders(spark, [])).count() == 0


def test_dim_date_covers_every_day(spark):
    two = orders(spark, [delivered("a", "2016-02-27 10:00:00"), delivered("b", "2016-03-01 00:00:00")])
    got = [(r.date.day, r.is_weekend) for r in marts.dim_date(two).orderBy("date").collect()]
    assert got == [(27, 1), (28, 1), (29, 0), (1, 0)]


def test_few_customers_and_recency(spark):
    placed = orders(
        spark,
        [
            delivered("a", "2017-01-01 00:00:00"),
            delivered("b", "2017-01-03 12:00:00"),
            {"order_id": "c", "order_status": "shipped", "order_purchase_timestamp": "2017-01-11 00:00:00"},
        ],
    )
    people = customers(spark, ("a", "u1", "A"), ("b", "u2", "B"), ("c", "u3", "C"))
    base = marts.rfm_base(placed, people, items(spark, [("a", 1, "p", "s", 10, 1)]))
    got = {r.customer_unique_id: (r.recency, r.frequency, r.monetary) for r in base.collect()}
    # Recency counts from the newest order of any status; no items means nothing spent.
    assert got == {"u1": (10.0, 1, Decimal("11.00")), "u2": (7.5, 1, Decimal("0.00"))}
    scores = {r.customer_unique_id: (r.r_score, r.f_score, r.m_score) for r in marts.rfm_scores(base).collect()}
    assert scores == {"u1": (1, 1, 2), "u2": (2, 1, 1)}


def test_customer_in_two_cities_keeps_two_rows(spark):
    placed = orders(spark, [delivered("a", "2017-01-01 00:00:00"), delivered("b", "2017-01-02 00:00:00")])
    people = customers(spark, ("a", "u1", "A"), ("b", "u1", "B"), ("c", "u2", "C"))
    segments = marts.rfm_segments(marts.rfm_scores(marts.rfm_base(placed, people, items(spark, []))))
    dim = {(r.customer_unique_id, r.customer_city): r for r in marts.dim_customers(people, segments).collect()}
    assert set(dim) == {("u1", "A"), ("u1", "B"), ("u2", "C")}
    assert dim["u1", "A"].frequency == dim["u1", "B"].frequency == 2
    idle = dim["u2", "C"]
    assert (idle.recency, idle.frequency, idle.rfm_score, idle.rfm_segment) == (-1.0, 0, "000", "Non-Active")


@pytest.mark.parametrize(
    "r,f,name",
    [
        (5, 3, "Champions"),
        (4, 5, "Champions"),
        (3, 3, "Loyal Customers"),
        (4, 1, "Recent Customers"),
        (2, 5, "At Risk"),
        (1, 1, "Lost"),
        (3, 1, "About to Sleep"),
        (0, 2, "Others"),
    ],
)
def test_segments(spark, r, f, name):
    scores = spark.createDataFrame([(r, f)], "r_score int, f_score int")
    assert marts.rfm_segments(scores).first().rfm_segment == name


def test_delivery_metrics(spark):
    def order(name, status, arrived, due="2017-01-10 00:00:00"):
        return {
            "order_id": name,
            "order_status": status,
            "order_delivered_customer_date": arrived,
            "order_estimated_delivery_date": due,
        }

    df = marts.delivery_metrics(
        orders(
            spark,
            [
                order("late", "delivered", "2017-01-11 12:00:00"),
                order("exact", "delivered", "2017-01-10 00:00:00"),
                order("no date", "delivered", None),
                order("no status", None, "2017-01-09 00:00:00"),
                order("no status late", None, "2017-01-11 00:00:00"),
                order("not delivered", "canceled", "2017-01-12 00:00:00"),
            ],
        )
    )
    got = {r.order_id: (r.is_late_delivery, r.delivery_status, r.delivery_delay_days) for r in df.collect()}
    assert got == {
        "late": (1, "late", 1.5),
        "exact": (0, "on_time_or_early", 0.0),
        "no date": (0, "on_time_or_early", None),
        "no status": (0, "on_time_or_early", -1.0),
        "no status late": (0, "late", 1.0),
        "not delivered": (0, "not_delivered", 2.0),
    }


def test_delay_across_a_clock_change(spark):
    """Seven zone-less days are seven days, whatever the session zone did in between."""
    df = orders(
        spark,
        [
            {
                "order_id": "a",
                "order_delivered_customer_date": "2018-11-07 00:00:00",
                "order_estimated_delivery_date": "2018-10-31 00:00:00",
            }
        ],
    )
    assert marts.delivery_metrics(df).first().delivery_delay_days == 7.0


def test_fact_orders_defaults(spark):
    placed = orders(spark, [delivered("a", "2017-01-01 10:00:00"), delivered("b", "2017-01-02 10:00:00")])
    payments = raw_table(
        spark,
        "order_payments",
        [
            {"order_id": "a", "payment_sequential": 1, "payment_type": "card", "payment_installments": 3, "payment_value": money(5)},
            {"order_id": "a", "payment_sequential": 2, "payment_type": "card", "payment_installments": 1, "payment_value": money(6)},
            {"order_id": "a", "payment_sequential": 3, "payment_type": "voucher", "payment_installments": 1, "payment_value": None},
        ],
    )
    reviews = raw_table(
        spark,
        "order_reviews",
        [{"review_id": "r", "order_id": "a", "review_score": 2}, {"review_id": "q", "order_id": "a", "review_score": 4}],
    )
    fact = marts.fact_orders(
        placed, customers(spark, ("a", "u", "A")), items(spark, [("a", 1, "p", "s", 1, 2), ("a", 2, "p", "s", 3, 4)]), payments, reviews
    )
    a, b = sorted(fact.collect(), key=lambda r: r.order_id)
    assert (a.order_revenue, a.order_total_payment_value, a.payment_installments_max, a.payment_type_nunique, a.review_score) == (
        Decimal("10.00"), Decimal("11.00"), 3, 2, 4)
    assert (b.order_revenue, b.order_total_payment_value, b.payment_installments_max, b.payment_type_nunique) == (
        Decimal("0.00"), Decimal("0.00"), 0, 0)
    assert b.review_score is None and b.customer_unique_id is None and b.delivery_delay_days is None


def test_fact_sales_drops_items_without_partners(spark):
    placed = orders(spark, [delivered("a", "2017-01-01 10:00:00"), delivered("b", "2017-01-01 10:00:00", "gone")])
    lines = items(spark, [("a", 1, "p", "s", 1, 2), ("b", 1, "p", "s", 1, 2), ("x", 1, "p", "s", 1, 2)])
    assert [r.order_id for r in marts.fact_sales(lines, placed, customers(spark, ("a", "u", "A"))).collect()] == ["a"]


def test_flat_items_skips_joins_nobody_reads(spark):
    placed = orders(spark, [delivered("a", "2017-01-01 10:00:00")])
    lines = items(spark, [("a", 1, "p", "s", 1, 2)])
    empty = [raw_table(spark, n, []) for n in ("order_payments", "order_reviews")]
    attributes = marts.order_attributes(placed, customers(spark, ("a", "u", "A")), lines, *empty)
    lookups = [raw_table(spark, n, []) for n in ("products", "category_translation", "sellers")]
    narrow = marts.flat_items(lines, attributes, *lookups, columns=("order_id", "revenue"))
    assert "Join" not in narrow._jdf.queryExecution().optimizedPlan().toString()
    full = marts.flat_items(lines, attributes, *lookups).first()
    assert full.product_category_name_english == "unknown"
    assert (full.missing_product_category_flag, full.missing_review_score_flag, full.missing_delivery_info_flag) == (1, 1, 1)
    assert (full.order_month, full.order_weekday, full.purchase_hour) == ("2017-01", "Sunday", 10)
