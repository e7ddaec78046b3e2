from __future__ import annotations

import pytest

from tests.helpers import bag, items, money, orders, plan, raw_table, ts
from tradewind.operators.quality import (
    DataValidationError,
    assert_valid,
    check_fk,
    check_non_negative,
    check_not_null,
    check_range,
    check_unique,
    quality_report,
    schema_contract,
    union_all,
    validate_all,
)
from tradewind.plans.cleaning import clean_and_count, fact_order_item_sales
from tradewind.plans.marts import dim_sellers
from tradewind.plans.warehouse import ITEM_SALES, Warehouse
from tradewind.schemas import RULES
from tradewind.sources import testdata


def valid_bundle(spark) -> dict:
    return {
        "customers": raw_table(spark, "customers", [{"customer_id": "c1", "customer_unique_id": "u1"}]),
        "orders": orders(
            spark,
            [{"order_id": "o1", "customer_id": "c1", "order_status": "delivered", "order_purchase_timestamp": "2017-01-01 10:00:00"}],
        ),
        "order_items": items(spark, [("o1", 1, "p1", "s1", 100, 10)]).drop("revenue"),
        "order_payments": raw_table(
            spark, "order_payments", [{"order_id": "o1", "payment_sequential": 1, "payment_value": money(110)}]
        ),
        "order_reviews": raw_table(
            spark, "order_reviews", [{"review_id": "r1", "order_id": "o1", "review_score": 5}]
        ),
        "products": raw_table(spark, "products", [{"product_id": "p1", "product_category_name": "cat"}]),
        "sellers": raw_table(spark, "sellers", [{"seller_id": "s1"}]),
        "category_translation": raw_table(
            spark, "category_translation", [{"product_category_name": "cat", "product_category_name_english": "c"}]
        ),
    }


def run(bundle):
    fact = fact_order_item_sales(
        bundle["order_items"], bundle["orders"], bundle["products"], bundle["category_translation"]
    )
    return validate_all(bundle, fact)


def test_valid_bundle_passes(spark):
    checks = run(valid_bundle(spark))
    assert checks.where("violations > 0").count() == 0
    assert_valid(checks)


def test_missing_customer(spark):
    bundle = valid_bundle(spark)
    bundle["customers"] = raw_table(spark, "customers", [{"customer_id": "other"}])
    with pytest.raises(DataValidationError, match="orders.customer_id -> customers.customer_id"):
        assert_valid(run(bundle))


def test_negative_price(spark):
    bundle = valid_bundle(spark)
    bundle["order_items"] = items(spark, [("o1", 1, "p1", "s1", -1, 10)]).drop("revenue")
    with pytest.raises(DataValidationError, match="order_items.price contains 1 negative values"):
        assert_valid(run(bundle))


def test_first_rule_in_order_is_reported(spark):
    """A null key comes before a bad score, although both are wrong."""
    bundle = valid_bundle(spark)
    bundle["order_reviews"] = raw_table(
        spark, "order_reviews", [{"review_id": "r1", "order_id": None, "review_score": 9}]
    )
    with pytest.raises(DataValidationError, match="order_reviews.order_id contains 1 null"):
        assert_valid(run(bundle))


def test_fact_without_purchase_time(spark):
    bundle = valid_bundle(spark)
    bundle["orders"] = orders(spark, [{"order_id": "o1", "customer_id": "c1"}])
    with pytest.raises(DataValidationError, match="null values after joins"):
        assert_valid(run(bundle))


def test_single_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", -2), (None, None), (None, 7)], "k string, n int")
    found = {
        "null": check_not_null(df, "t", ["k", "n"]).collect(),
        "unique": check_unique(df, "t", ["k"]).collect(),
        "sign": check_non_negative(df, "t", ["n"]).collect(),
        "range": check_range(df, "t", "n", 1, 5).collect(),
    }
    assert [r.violations for r in found["null"]] == [2, 1]
    assert [r.message for r in found["null"]] == ["t.k contains 2 null values", "t.n contains 1 null values"]
    # Repeated null keys are duplicates; null values pass sign and range.
    assert found["unique"][0].violations == 2
    assert found["sign"][0].violations == 1
    assert found["range"][0].violations == 2


def test_fk_counts_distinct_values_and_skips_nulls(spark):
    child = spark.createDataFrame([("x",), ("x",), ("y",), (None,), ("ok",)], "k string")
    parent = spark.createDataFrame([("ok",), (None,)], "k string")
    assert check_fk(child, "c", "k", parent, "p", "k").first().violations == 2


def test_checks_on_empty_tables(spark):
    df = spark.createDataFrame([], "k string, n int")
    assert check_unique(df, "t", ["k"]).first().violations == 0
    assert check_not_null(df, "t", ["k"]).first().violations == 0


def test_report(spark):
    raw = {"t": spark.createDataFrame([("a",), ("a",), (None,)], "k string")}
    cleaned = {"t": raw["t"].distinct(), "only_clean": raw["t"]}
    got = {(r.table_name, r.metric, r.column_name): r.value for r in quality_report(raw, cleaned).collect()}
    assert got == {
        ("t", "raw_row_counts", None): 3,
        ("t", "cleaned_row_counts", None): 2,
        ("t", "rows_removed_by_cleaning", None): 1,
        ("t", "null_counts", "k"): 1,
        ("only_clean", "cleaned_row_counts", None): 3,
        ("only_clean", "null_counts", "k"): 1,
    }


def test_contract_names_drift(spark):
    good = dim_sellers(raw_table(spark, "sellers", [{"seller_id": "s"}]))
    assert {r.verdict for r in schema_contract({"dim_sellers": good}).collect()} == {"ok"}
    bad = good.drop("seller_city").selectExpr("seller_id", "1 as seller_state", "2 as extra")
    got = {r.column_name: r.verdict for r in schema_contract({"dim_sellers": bad}).collect()}
    assert got == {
        "seller_id": "ok",
        "seller_city": "missing",
        "seller_state": "other type",
        "extra": "unexpected",
    }


def test_timestamps_in_bundle_are_zone_less(spark):
    assert valid_bundle(spark)["orders"].first()["order_purchase_timestamp"] == ts("2017-01-01 10:00:00")


def counted(spark, scratch, name, raw):
    watched, measured = clean_and_count(name, raw)
    watched.write.parquet(f"{scratch}/{name}")
    stored = spark.read.parquet(f"{scratch}/{name}")
    return stored, measured(stored)


def test_counts_taken_while_writing_equal_counts_by_reading(spark, folder):
    """On the given tables, cleaned and stored, and with rows that break the rules."""
    w = Warehouse(spark, lambda name: testdata.broken(name, testdata.raw_table(spark, folder, name)))
    cleaned, fact = w.cleaned_all(), w.mart(ITEM_SALES)
    assert set(w.measured) == {*RULES, ITEM_SALES}
    by_reading = validate_all(cleaned, fact)
    by_counts = validate_all(cleaned, fact, w.measured)
    assert bag(by_counts) == bag(by_reading)
    assert by_counts.where("violations > 0 and check_name <> 'fk'").count() > 10
    assert by_counts.where("check_name = 'unique' and violations > 0").isEmpty()


def test_key_made_unique_is_not_shuffled_again(spark, folder):
    w = Warehouse(spark, lambda name: testdata.raw_table(spark, folder, name))
    cleaned, fact = w.cleaned_all(), w.mart(ITEM_SALES)
    shuffles = lambda checks: plan(checks).count("Exchange hashpartitioning")
    by_reading, by_counts = validate_all(cleaned, fact), validate_all(cleaned, fact, w.measured)
    assert shuffles(by_reading) - shuffles(by_counts) == len(RULES)


def test_keys_that_cleaning_spells_alike_are_grouped_again(spark, scratch):
    """Distinct as text, equal as numbers: the key of the written table is not the one made unique."""
    layout = "order_id string, payment_sequential string, payment_type string, payment_installments int, payment_value string"
    rows = [("o", "1", "a", 1, "5.00"), ("o", "01", "b", 1, "-6.00"), ("o", "2", "c", 1, "x"), ("p", "2", "d", 1, "7")]
    stored, found = counted(spark, scratch, "order_payments", spark.createDataFrame(rows, layout))
    assert found.rekeyed == 1 and found.violations[("non_negative", "payment_value")] == 1
    bundle = {**valid_bundle(spark), "order_payments": stored}
    fact = fact_order_item_sales(*(bundle[t] for t in ("order_items", "orders", "products", "category_translation")))
    checks = validate_all(bundle, fact, {"order_payments": found})
    unique = checks.where("check_name = 'unique' and table_name = 'order_payments'").first()
    assert unique.violations == 1 and "duplicate rows on key [order_id, payment_sequential]" in unique.message


def test_counts_that_do_not_fit_the_stored_table_are_not_used(spark, scratch):
    """As after a stage that ran twice."""
    watched, measured = clean_and_count("sellers", raw_table(spark, "sellers", [{"seller_id": "s1"}, {"seller_id": None}]))
    watched.write.parquet(f"{scratch}/sellers")
    stored = spark.read.parquet(f"{scratch}/sellers")
    assert measured(stored).violations == {("not_null", "seller_id"): 1}
    assert measured(stored.union(stored)) is None


def test_union_of_many_frames_keeps_their_order_of_columns(spark):
    frames = [spark.range(i, i + 1).selectExpr("id", "id * 2 AS twice") for i in range(7)]
    assert sorted(map(tuple, union_all(frames).collect())) == [(i, 2 * i) for i in range(7)]
