from __future__ import annotations

from datetime import date
from glob import glob

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, orders, plan
from tradewind.operators import upsert as U
from tradewind.operators.upsert import (
    MonthlyTable,
    incremental_filter,
    lookback_start,
    read_monthly,
    upsert,
    write_monthly,
)
from tradewind.plans import incremental, marts
from tradewind.plans.catalog import open_warehouse
from tradewind.schemas import MARTS

LAYOUT = "id string, day date, v int"


def placed(spark, *times):
    return orders(
        spark,
        [{"order_id": str(i), "order_purchase_timestamp": t} for i, t in enumerate(times)],
    )


def ids(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


def test_first_build_takes_everything(spark):
    source = placed(spark, None, "1960-01-01 00:00:00", "2017-01-01 00:00:00")
    assert incremental_filter(source, "order_purchase_timestamp", None, "x").count() == 3


def test_empty_target_starts_at_the_epoch(spark):
    source = placed(spark, None, "1960-01-01 00:00:00", "2017-01-01 00:00:00")
    target = placed(spark)
    kept = incremental_filter(source, "order_purchase_timestamp", target, "order_purchase_timestamp")
    assert ids(kept) == ["2"]


def test_bound_is_inclusive_and_older_rows_are_ignored(spark):
    target = placed(spark, "2017-01-10 12:00:00", "2017-01-05 00:00:00")
    source = placed(spark, "2017-01-07 12:00:00", "2017-01-07 11:59:59", "2017-02-01 00:00:00", None)
    kept = incremental_filter(source, "order_purchase_timestamp", target, "order_purchase_timestamp")
    assert ids(kept) == ["0", "2"]


def test_day_target_compares_with_midnight(spark):
    target = spark.createDataFrame([(date(2017, 1, 10),)], "order_date date")
    source = placed(spark, "2017-01-07 00:00:00", "2017-01-06 23:59:59")
    assert ids(incremental_filter(source, "order_purchase_timestamp", target, "order_date")) == ["0"]


def test_start_is_a_literal_that_reaches_the_scan(spark, scratch):
    placed(spark, "2017-01-07 00:00:00").write.parquet(f"{scratch}/orders")
    source = spark.read.parquet(f"{scratch}/orders")
    kept = incremental_filter(source, "order_purchase_timestamp", source, "order_purchase_timestamp")
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_purchase_timestamp), GreaterThanOrEqual" in text


def stored(spark, path, rows):
    return write_monthly(spark.createDataFrame(rows, LAYOUT), path, "day")


def state(table):
    return sorted((tuple(r) for r in table.table().collect()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("where", ["new", "old"])
def test_delete_and_insert(spark, scratch, where):
    d1, d2, d3 = date(2017, 1, 5), date(2017, 2, 5), date(2017, 3, 5)
    before = [("a", d1, 1), ("b", d2, 1), ("c", d2, 1), ("e", d3, 1), ("n", None, 1)]
    old = stored(spark, f"{scratch}/old", before)
    table, place = old, f"{scratch}/{where}"
    batch = spark.createDataFrame([("b", d3, 2), ("d", d2, 2), ("d", d2, 3)], LAYOUT)
    # b moved to another month; a key that occurs twice in the batch is inserted twice.
    dated = [("a", d1, 1), ("b", d3, 2), ("c", d2, 1), ("d", d2, 2), ("d", d2, 3), ("e", d3, 1)]
    untouched = set(glob(f"{scratch}/old/_month=2017-01/*"))
    for _ in range(2):  # The second run, in place, changes nothing.
        table = upsert(table, place, batch, ["id"], "day")
        assert state(table) == [*dated, ("n", None, 1)]
        assert state(read_monthly(spark, place, old.layout)) == state(table)
    # In place the other months keep their files; a new version leaves the old one as it was.
    assert set(glob(f"{scratch}/old/_month=2017-01/*")) == untouched
    if where == "new":
        assert state(read_monthly(spark, f"{scratch}/old", old.layout)) == before


def test_month_that_loses_its_last_row(spark, scratch):
    first, new = date(2017, 1, 5), date(2017, 2, 5)
    old = stored(spark, f"{scratch}/t", [("a", first, 1), ("b", new, 1)])
    got = upsert(old, f"{scratch}/t", spark.createDataFrame([("a", new, 2)], LAYOUT), ["id"], "day")
    assert state(got) == [("a", new, 2), ("b", new, 1)] and got.months() == ["2017-02"]


def test_empty_batch_changes_nothing(spark, scratch):
    old = stored(spark, f"{scratch}/t", [("a", date(2017, 1, 5), 1)])
    for path in ("t", "new"):
        got = upsert(old, f"{scratch}/{path}", spark.createDataFrame([], LAYOUT), ["id"], "day")
        assert got.months() == ["2017-01"] and len(state(got)) == 1


def test_failed_write_leaves_the_table(spark, scratch):
    old = stored(spark, f"{scratch}/t", [("a", date(2017, 1, 5), 1)])
    bad = spark.createDataFrame([("a", date(2017, 1, 6), 2)], LAYOUT).withColumn(
        "v", F.raise_error(F.lit("broken")).cast("int")
    )
    for path in ("t", "new"):
        try:
            upsert(old, f"{scratch}/{path}", bad, ["id"], "day")
        except Exception as error:
            assert "broken" in str(error)
    assert state(read_monthly(spark, f"{scratch}/t", old.layout)) == [("a", date(2017, 1, 5), 1)]
    assert read_monthly(spark, f"{scratch}/new", old.layout) is None
    good = spark.createDataFrame([("a", date(2017, 1, 6), 2)], LAYOUT)
    assert state(upsert(old, f"{scratch}/new", good, ["id"], "day")) == [("a", date(2017, 1, 6), 2)]


def test_no_target_is_a_first_build(spark, scratch):
    batch = spark.createDataFrame([("a", date(2017, 1, 5), 1), ("n", None, 2)], LAYOUT)
    assert state(upsert(None, f"{scratch}/t", batch, ["id"], "day")) == [("a", date(2017, 1, 5), 1), ("n", None, 2)]


def test_newest_value_comes_from_the_last_month_only(spark, scratch):
    rows = [("a", date(2017, 1, 5), 1), ("b", date(2017, 3, 9), 1), ("n", None, 1)]
    table = stored(spark, f"{scratch}/t", rows)
    assert lookback_start(table, "day") == "2017-03-06 00:00:00"
    # No other month is opened: with broken files there the result is the same.
    for file in glob(f"{scratch}/t/_month=2017-01/*.parquet") + glob(f"{scratch}/t/_month=none/*.parquet"):
        with open(file, "w", encoding="utf-8") as broken:
            broken.write("broken")
    assert lookback_start(MonthlyTable(spark, table.path, table.layout), "day") == "2017-03-06 00:00:00"


def test_new_version_copies_other_months_without_a_shuffle(spark, scratch):
    days = [date(2017, m, 5) for m in range(1, 7)]
    old = stored(spark, f"{scratch}/old", [(f"k{i}", d, 1) for i, d in enumerate(days * 50)])
    batch = spark.createDataFrame([("k5", days[5], 2)], LAYOUT)
    new = upsert(old, f"{scratch}/new", batch, ["id"], "day")
    assert new.months() == old.months()
    # The version stands on its own files.
    assert all("/new/" in name for name in new.rows().inputFiles())
    assert new.table().where("v = 2").count() == 1 and new.table().count() == 300


def test_ended_between_months_and_repeated(spark, scratch, monkeypatch):
    """A run in place that ends after its first month is completed by the next one."""
    d1, d2 = date(2017, 1, 30), date(2017, 2, 1)
    old = stored(spark, f"{scratch}/t", [("a", d1, 1), ("b", d2, 1)])
    batch = spark.createDataFrame([("a", d1, 2), ("c", d2, 2)], LAYOUT)
    whole = U._replace_months
    with monkeypatch.context() as patch:
        patch.setattr(U, "_replace_months", lambda t, rows, months: whole(t, rows.where("_month = '2017-01'"), months[:1]))
        upsert(old, f"{scratch}/t", batch, ["id"], "day")
    half = read_monthly(spark, f"{scratch}/t", old.layout)
    assert state(half) == [("a", d1, 2), ("b", d2, 1)] and lookback_start(half, "day") <= "2017-01-30 00:00:00"
    assert state(upsert(half, f"{scratch}/t", batch, ["id"], "day")) == [("a", d1, 2), ("b", d2, 1), ("c", d2, 2)]


def details(w):
    return [w.stage(n) for n in ("customers", "order_items", "order_payments", "order_reviews")]


def by_month(w, scratch):
    return write_monthly(w.stage("orders"), f"{scratch}/orders", "order_purchase_timestamp").rows()


@pytest.mark.parametrize("limit", [U.BROADCAST_BYTES, 0])
def test_cut_plus_refresh_equals_full_build(spark, folder, scratch, limit, monkeypatch):
    """Building up to a day and refreshing gives the same fact as building everything at once, with
    batches that are sent to every task and larger ones."""
    monkeypatch.setattr(U, "BROADCAST_BYTES", limit)
    w = open_warehouse(spark, folder)
    source, s = by_month(w, scratch), w.stage
    full = marts.fact_orders(s("orders"), *details(w))
    old = write_monthly(full.where("order_date < date'2000-06-01'"), f"{scratch}/fact", "order_date")
    new = incremental.refresh_fact_orders(old, f"{scratch}/fact2", source, *details(w))
    assert bag(new.table()) == bag(full)
    sales = marts.fact_sales(s("order_items"), s("orders"), s("customers"))
    old = write_monthly(sales.where("order_date < date'2000-06-01'"), f"{scratch}/sales", "order_date")
    new = incremental.refresh_fact_sales(old, f"{scratch}/sales2", s("order_items"), source, s("customers"))
    assert bag(new.table()) == bag(sales)


def test_refresh_of_an_empty_and_of_no_target(spark, folder, scratch):
    w = open_warehouse(spark, folder)
    source = by_month(w, scratch)
    empty = write_monthly(spark.createDataFrame([], MARTS["fact_orders"]), f"{scratch}/a", "order_date")
    for place, target in (("b", empty), ("c", None)):
        got = incremental.refresh_fact_orders(target, f"{scratch}/{place}", source, *details(w))
        assert got.table().count() == w.stage("orders").count()


def test_refresh_reads_recent_months_and_batch_items_only(spark, folder, scratch):
    w = open_warehouse(spark, folder)
    source = by_month(w, scratch)
    sales = write_monthly(w.mart("fact_sales"), f"{scratch}/sales", "order_date")
    recent = incremental_filter(source, "order_purchase_timestamp", sales, "order_date")
    assert "PartitionFilters: [isnotnull(_month" in plan(recent)
    batch = plan(incremental.fact_sales_batch(sales, w.stage("order_items"), source, w.stage("customers")))
    # The filter by the batch's orders sits right on the scan of the items, below any exchange.
    lines = batch.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "order_item_id" in line)
    above = "".join(lines[scan - 3 : scan])
    assert "LeftSemi" in above and "Exchange" not in above


def test_order_feed(spark, folder, scratch):
    """Orders arriving in files end up in the fact; a corrected order replaces its row."""
    from tradewind.streaming.order_feed import TOO_OLD, follow_orders

    w = open_warehouse(spark, folder)
    tables = {n: w.stage(n) for n in ("customers", "order_items", "order_payments", "order_reviews")}
    path, inbox = f"{scratch}/fact", f"{scratch}/inbox"
    full = w.mart("fact_orders")
    cut = F.col("order_date") < F.date_sub(full.agg(F.max("order_date")).scalar(), 2)
    old = full.where(cut).withColumn("order_status", F.lit("outdated"))
    write_monthly(old, path, "order_date")
    newest = old.agg(F.max("order_purchase_timestamp")).first()[0]
    w.stage("orders").write.parquet(inbox)
    for _ in range(2):  # Nothing new the second time.
        follow_orders(spark, inbox, tables, path, f"{scratch}/progress").awaitTermination()
        fact = read_monthly(spark, path, MARTS["fact_orders"]).table()
        assert fact.count() == full.count()
        recent = F.col("order_purchase_timestamp") >= F.lit(newest).cast("timestamp_ntz") - F.expr("interval 3 days")
        assert fact.where(recent & (F.col("order_status") == "outdated")).count() == 0
        assert fact.where(~recent & (F.col("order_status") != "outdated")).count() == 0
    late = spark.read.parquet(f"{path}/{TOO_OLD}")
    assert late.count() == w.stage("orders").where(~recent).count() > 0


def test_feed_does_not_depend_on_how_files_fall_into_batches(spark, folder, scratch):
    from tradewind.streaming.order_feed import follow_orders

    w = open_warehouse(spark, folder)
    tables = {n: w.stage(n) for n in ("customers", "order_items", "order_payments", "order_reviews")}
    full = w.mart("fact_orders")
    newest = full.agg(F.max("order_purchase_timestamp").alias("t")).first().t
    old = full.where(F.col("order_purchase_timestamp") < F.lit(newest).cast("timestamp_ntz") - F.expr("interval 30 days"))
    recent = w.stage("orders").join(old.select("order_id"), "order_id", "left_anti")
    found = []
    for files in (1, 4):
        path, inbox = f"{scratch}/fact{files}", f"{scratch}/inbox{files}"
        write_monthly(old, path, "order_date")
        # The newest orders arrive first.
        for n, part in enumerate(recent.orderBy(F.desc("order_purchase_timestamp")).randomSplit([1.0] * files, 5)):
            part.coalesce(1).write.parquet(f"{inbox}/{n}")
            follow_orders(spark, f"{inbox}/*", tables, path, f"{scratch}/progress{files}").awaitTermination()
        found.append(bag(read_monthly(spark, path, MARTS["fact_orders"]).table()))
    assert sum(found[0].values()) >= sum(found[1].values()) > old.count()
