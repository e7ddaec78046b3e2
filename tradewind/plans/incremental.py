"""Incremental refresh of the two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from tradewind.operators import upsert as U
from tradewind.operators.upsert import MonthlyTable, incremental_filter, upsert
from tradewind.plans import marts
from tradewind.schemas import MARTS
from tradewind.session import materialize, stored_bytes

PURCHASED = "order_purchase_timestamp"
ORDERS_KEY = ("order_id",)
SALES_KEY = ("order_id", "order_item_id")


def _only(df: DataFrame, wanted: DataFrame, key: str, few: bool) -> DataFrame:
    """Rows that belong to the batch.

    Keys few enough to broadcast filter at the scan, below an aggregate of ``df``, so nothing older is
    shuffled. With more of them the join shuffles both sides, or reuses the aggregate's partitioning.
    """
    keys = wanted.select(key)
    return df.join(F.broadcast(keys) if few else keys.distinct(), key, "left_semi")


def _few(recent: DataFrame) -> bool:
    """Whether a stored batch has few enough orders to send their keys to every task."""
    return stored_bytes(recent) <= U.BROADCAST_BYTES


def recent_orders(
    orders: DataFrame, target: DataFrame | MonthlyTable | None, target_column: str
) -> DataFrame:
    return materialize(incremental_filter(orders, PURCHASED, target, target_column), "recent")


def fact_orders_batch(
    target: DataFrame | MonthlyTable | None,
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """Order fact of the lookback window, which starts at the newest purchase in the target."""
    return fact_orders_of(
        recent_orders(orders, target, PURCHASED), customers, items, payments, reviews
    )


def fact_orders_of(
    recent: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """Order fact of some orders, a stored table."""
    few = _few(recent)
    totals = (marts.order_items_agg(items), marts.payments_agg(payments), marts.reviews_agg(reviews))
    return marts.fact_orders_from_totals(
        recent,
        _only(customers, recent, "customer_id", few),
        *(_only(df, recent, "order_id", few) for df in totals),
    )


def fact_sales_batch(
    target: DataFrame | MonthlyTable | None,
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Item fact of the lookback window, which starts at the newest *day* in the target."""
    recent = recent_orders(orders, target, "order_date")
    few = _few(recent)
    return marts.fact_sales(
        _only(items, recent, "order_id", few), recent, _only(customers, recent, "customer_id", few)
    )


def refresh_fact_orders(
    target: MonthlyTable | None,
    path: str,
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> MonthlyTable:
    """A stored order fact brought up to date, as a new version at ``path``; without one, a full build."""
    batch = (
        marts.fact_orders(orders, customers, items, payments, reviews)
        if target is None
        else fact_orders_batch(target, orders, customers, items, payments, reviews)
    )
    return upsert(target, path, _as(batch, "fact_orders"), ORDERS_KEY, "order_date")


def refresh_fact_sales(
    target: MonthlyTable | None,
    path: str,
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
) -> MonthlyTable:
    """A stored item fact brought up to date, as a new version at ``path``; without one, a full build."""
    batch = (
        marts.fact_sales(items, orders, customers)
        if target is None
        else fact_sales_batch(target, items, orders, customers)
    )
    return upsert(target, path, _as(batch, "fact_sales"), SALES_KEY, "order_date")


def _as(batch: DataFrame, name: str) -> DataFrame:
    return batch.select(*MARTS[name].fieldNames())
