"""Scans in small splits, and what the shuffles of dedup and flat items carry."""

from __future__ import annotations

import re
from threading import Barrier

import pytest

from tests.helpers import bag, plan
from tradewind.operators.dedup import dedup_keep_first
from tradewind.plans.catalog import open_warehouse
from tradewind.plans.warehouse import ITEM_SALES, Warehouse
from tradewind.schemas import RULES
from tradewind.session import _bytes, small_splits
from tradewind.sources import testdata

KEY = "spark.sql.files.maxPartitionBytes"


def test_small_splits_keep_the_settings_of_the_caller(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        apart = small_splits(spark)
        assert apart.conf.get("spark.sql.shuffle.partitions") == "5"
        assert (_bytes(apart.conf.get(KEY)), _bytes(spark.conf.get(KEY))) == (16 << 20, 128 << 20)
        apart.conf.set(KEY, "4m")
        assert _bytes(small_splits(apart).conf.get(KEY)) == 4 << 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize(("text", "size"), [("7", 7), ("7b", 7), ("16m", 16 << 20), ("1GB", 1 << 30), ("2k", 2048)])
def test_sizes(text, size):
    assert _bytes(text) == size


def test_warehouse_reads_in_small_splits(spark, folder):
    w = open_warehouse(spark, folder)
    for table in (w.raw("order_items"), w.cleaned("order_items")):
        assert _bytes(table.sparkSession.conf.get(KEY)) == 16 << 20


LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


@pytest.mark.parametrize("name", ["order_items", "order_payments"])
def test_columns_made_after_dedup_equal_those_made_before(spark, scratch, name):
    """Repeated rows and keys, nulls in keys and positions."""
    rows = [
        (1, 5, 7, 1, 2.0, 10.5, 0.1, 0.02, "R", "F", None),
        (1, 5, 7, 1, 2.0, 10.5, 0.1, 0.02, "A", "F", None),
        (1, None, 7, 1, 3.0, 11.5, 0.1, 0.02, "A", "F", None),
        (1, 6, 2, 2, None, 11.555, 0.0, None, "N", "F", None),
        (1, 6, 2, 2, 4.125, 11.555, 0.0, None, "N", "F", None),
        (None, 9, 9, None, 1.0, 1.0, 0.0, 0.0, None, "F", None),
        (None, 8, 9, None, 1.0, 1.0, 0.0, 0.0, None, "F", None),
    ]
    spark.createDataFrame(rows * 2, LINES).write.parquet(f"{scratch}/lineitem.parquet")
    raw, key = testdata.raw_table(spark, scratch, name), RULES[name].key
    late = dedup_keep_first(raw, key, late=testdata.by_position(name))
    plain = dedup_keep_first(raw, key)
    lines = plan(late).splitlines()
    assert late.dtypes == plain.dtypes and bag(late) == bag(plain) and late.count() == 3
    wide = next(c for c in testdata.by_position(name))
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    # Made above the shuffle only.
    assert not any(f"AS {wide}#" in line for line in lines[shuffle:])


def test_flat_items_shuffle_no_copies_of_amounts(spark, folder):
    w = open_warehouse(spark, folder)
    lines = plan(w.flat()).splitlines()
    made = {i: line for i, line in enumerate(lines) if re.search("AS (item_revenue|shipping_revenue|revenue)#", line)}
    first = next(i for i, line in enumerate(lines) if "Join" in line or "Exchange" in line)
    # The sums per order below the join are made of revenues of their own.
    assert made and min(made) < first
    above = {name for i, line in made.items() if i < first for name in re.findall(r"AS (\w*revenue)#", line)}
    assert above == {"item_revenue", "shipping_revenue", "revenue"}


def test_item_sales_are_left_in_the_order_of_orders(spark, folder):
    """The join with orders is the last one; rows of an order are stored side by side."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        w = Warehouse(spark, lambda name: testdata.raw_table(spark, folder, name), late=testdata.by_position)
        joins = [line for line in plan(w.item_sales()).splitlines() if "SortMergeJoin" in line]
    finally:
        spark.conf.unset(key)
    assert "SortMergeJoin [order_id#" in joins[0] and "SortMergeJoin [product_id#" in joins[1]


@pytest.mark.parametrize("name", ["fact_orders", ITEM_SALES])
def test_cleaned_tables_of_a_fact_are_built_together(spark, folder, name):
    """Each of the four that come first is asked for before any of them is done."""
    w = Warehouse(spark, lambda table: testdata.raw_table(spark, folder, table), late=testdata.by_position)
    first, asked, store = Barrier(4), [], w.cleaned

    def cleaned(table):
        asked.append(table)
        if len(asked) <= 4:
            first.wait(30)
        return store(table)

    w.cleaned = cleaned
    assert w.build(name).columns and len(asked) > 4
