"""Small helpers to build tables and look at plans."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.schemas import RAW


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def bag(df: DataFrame) -> Counter:
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def raw_table(spark, name: str, records: list[dict]) -> DataFrame:
    """A raw table from partial records; what a record leaves out is null."""
    layout = RAW[name]
    doubles = {f.name for f in layout if f.dataType.simpleString() == "double"}

    def value(record: dict, name: str):
        found = record.get(name)
        return float(found) if found is not None and name in doubles else found

    full = [tuple(value(r, f.name) for f in layout) for r in records]
    return spark.createDataFrame(full, layout)


def orders(spark, records: list[dict]) -> DataFrame:
    stamps = [f.name for f in RAW["orders"] if f.name.startswith("order_") and "_id" not in f.name]
    fixed = [
        {
            **{k: ts(v) if k in stamps and k != "order_status" else v for k, v in r.items()},
            "customer_id": r.get("customer_id", r.get("order_id")),
        }
        for r in records
    ]
    return raw_table(spark, "orders", fixed)


def items(spark, records: list[tuple]) -> DataFrame:
    """(order_id, item_id, product_id, seller_id, price, freight) rows, staged with revenue."""
    full = [
        {
            "order_id": o,
            "order_item_id": n,
            "product_id": p,
            "seller_id": s,
            "price": money(price),
            "freight_value": money(freight),
        }
        for o, n, p, s, price, freight in records
    ]
    return raw_table(spark, "order_items", full).withColumn(
        "revenue", F.col("price") + F.col("freight_value")
    )


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df: DataFrame) -> str:
    """The plan as adaptive execution left it after running it."""
    df.collect()
    return plan(df)
