"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from tests.helpers import final_plan, plan
from tradewind.operators.dedup import dedup_keep_first
from tradewind.plans.catalog import build_queries, open_warehouse
from tradewind.plans.incremental import fact_orders_batch

QUERIES = build_queries()
# Python runs inside tasks, on Arrow batches, in two places only: matrix products on blocks of vectors, and the
# quotes of lines of CSV files whose values may hold line breaks.
WITH_PYTHON = {"semantic_lookup", "semantic_lookup_blocks", "ingest_csv", "csv_unreadable"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name not in WITH_PYTHON:
        assert not re.search(r"EvalPython|InPandas|InArrow|PythonUDF", text)


def test_dedup_prunes_before_the_shuffle(spark, folder):
    w = open_warehouse(spark, folder)
    text = plan(dedup_keep_first(w.raw("order_items"), ["order_id", "order_item_id"]))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning") < partial


def test_scans_read_only_what_is_used(spark, folder):
    w = open_warehouse(spark, folder)
    w.mart("flat_items")
    text = plan(QUERIES["kpi_total_revenue"](spark, folder))
    assert "ReadSchema: struct<revenue:decimal(17,2),is_delivered:int>" in text
    assert "PushedFilters: [IsNotNull(is_delivered), EqualTo(is_delivered,1)]" in text


def test_delivered_filter_reaches_the_order_scan(spark, folder):
    text = plan(QUERIES["rfm_base"](spark, folder))
    assert "EqualTo(order_status,delivered)" in text


@pytest.mark.parametrize("name", ["kpi_category", "kpi_monthly", "kpi_customer_summary", "rfm_base", "fact_orders"])
def test_aggregates_start_before_the_shuffle(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "partial_sum" in text


def test_batch_filter_reaches_the_detail_scan(spark, folder):
    """With few batch keys the filter runs below the aggregate, so only batch rows are shuffled."""
    w = open_warehouse(spark, folder)
    s = w.stage
    batch = fact_orders_batch(
        w.mart("fact_orders"),
        *(s(n) for n in ("orders", "customers", "order_items", "order_payments", "order_reviews")),
    )
    lines = plan(batch).splitlines()
    aggregate = next(i for i, line in enumerate(lines) if "partial_sum(revenue" in line)
    assert "LeftSemi" in lines[aggregate + 1]


def test_recent_questions_prunes_before_the_shuffle(spark, folder):
    text = plan(QUERIES["recent_questions"](spark, folder))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning(user_id") < partial


def test_newest_purchase_is_computed_once(spark, folder):
    text = final_plan(QUERIES["rfm_base"](spark, folder))
    assert len(set(re.findall(r"Subquery subquery#(\d+)", text))) == 1


ORDER_KPIS = ["kpi_monthly_revenue", "kpi_monthly", "kpi_customer_summary", "kpi_review_delivery", "kpi_weekday_weekend", "kpi_retention", "kpi_late_impact"]
ROLLUPS = ["order_level_rollup", "headline_kpis", "grain_bias", "profile_monthly_kpi", "profile_delivery_review", "profile_weekday_weekend", "profile_customer_repeat"]


@pytest.mark.parametrize("name", ORDER_KPIS)
def test_delivered_filter_reaches_the_item_scan(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "EqualTo(is_delivered,1)" in text


@pytest.mark.parametrize("name", ORDER_KPIS + ROLLUPS)
def test_no_sort_of_all_items(spark, folder, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, folder))


def test_histogram_reads_the_reviews_once(spark, folder):
    text = plan(QUERIES["profile_review_histogram"](spark, folder))
    assert "orders.parquet" not in text and "/values-" in text
