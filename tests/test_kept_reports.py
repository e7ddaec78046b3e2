from __future__ import annotations

from glob import glob

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, rows
from tradewind.operators.upsert import PARTITION, read_monthly, upsert, write_monthly
from tradewind.plans import kept_reports, reports
from tradewind.plans.catalog import open_warehouse
from tradewind.schemas import MARTS, MONEY_SUM

NAMES = ("monthly_kpi", "delivery_review", "weekday_weekend")


def same_reports(parts, fact):
    orders = reports.read_orders(fact)
    for name in NAMES:
        # Rows in the order of the report, except that of days, which has none.
        got, want = getattr(kept_reports, name)(parts), getattr(reports, name)(orders)
        assert got.columns == want.columns
        assert (bag(got) == bag(want)) if name == "weekday_weekend" else (rows(got) == rows(want)), name


def written(w, scratch):
    return write_monthly(w.mart("fact_orders"), f"{scratch}/fact", "order_date")


def test_parts_of_a_whole_fact(spark, folder, scratch):
    fact = written(open_warehouse(spark, folder), scratch)
    parts = kept_reports.refresh_parts(None, fact, f"{scratch}/parts")
    assert 0 < parts.count() < fact.table().count()
    same_reports(parts, fact.table())


@pytest.mark.parametrize("days", [0, 40])
def test_refresh_counts_changed_months_only(spark, folder, scratch, days):
    """Rows of the other months are not opened: their files are broken before the parts are refreshed."""
    fact = written(open_warehouse(spark, folder), scratch)
    old = kept_reports.refresh_parts(None, fact, f"{scratch}/parts")
    newest = fact.table().agg(F.max("order_date")).scalar()
    # Orders of the last days change their amount and status, or move to an earlier month.
    batch = fact.table().where(F.col("order_date") > F.date_sub(newest, 20)).withColumns(
        {"order_revenue": (F.col("order_revenue") + 1).cast(MONEY_SUM), "order_date": F.date_sub("order_date", days)}
    )
    new = upsert(fact, f"{scratch}/new", batch.select(*MARTS["fact_orders"].fieldNames()), ["order_id"], "order_date")
    assert 0 < len(new.changed) < len(new.months())
    want = [(n, rows(getattr(reports, n)(reports.read_orders(new.table())))) for n in NAMES]
    for month in set(new.months()) - new.changed:
        for file in glob(f"{scratch}/new/{PARTITION}={month}/*.parquet"):
            with open(file, "w", encoding="utf-8") as broken:
                broken.write("broken")
    parts = kept_reports.refresh_parts(old, new, f"{scratch}/parts2")
    for name, found in want:
        assert sorted(rows(getattr(kept_reports, name)(parts)), key=str) == sorted(found, key=str)


def test_month_without_rows_any_more(spark, folder, scratch):
    fact = written(open_warehouse(spark, folder), scratch)
    old = kept_reports.refresh_parts(None, fact, f"{scratch}/parts")
    last, before = fact.months()[-1], fact.months()[-2]
    moved = fact.rows().where(F.col(PARTITION) == last).drop(PARTITION)
    moved = moved.withColumn("order_date", F.lit(f"{before}-01").cast("date"))
    new = upsert(fact, f"{scratch}/new", moved, ["order_id"], "order_date")
    assert last not in new.months() and last in new.changed
    same_reports(kept_reports.refresh_parts(old, new, f"{scratch}/parts2"), new.table())


def test_empty_fact_and_missing_parts(spark, scratch):
    fact = write_monthly(spark.createDataFrame([], MARTS["fact_orders"]), f"{scratch}/fact", "order_date")
    parts = kept_reports.refresh_parts(None, fact, f"{scratch}/parts")
    assert parts.count() == 0
    assert all(df.count() == 0 for df in kept_reports.summaries(parts).values())
    assert kept_reports.read_parts(spark, f"{scratch}/nothing") is None
    # Without parts of the version before, a refreshed fact is counted as a whole.
    again = read_monthly(spark, f"{scratch}/fact", MARTS["fact_orders"])
    assert kept_reports.refresh_parts(None, again, f"{scratch}/parts3").count() == 0
