"""Cleaning recipes: deduplicate, then coerce, driven by the rules of each table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.columns import cut_to_second, parse_money, parse_timestamp
from tradewind.operators.dedup import dedup_keep_first
from tradewind.operators.quality import Measured, watch
from tradewind.schemas import ITEM_SALES, RAW, RULES

_REKEYED = "_rekeyed"


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text that is no number becomes null; columns the table lacks are skipped."""
    return df.withColumns({c: parse_money(F.col(c)) for c in columns if c in df.columns})


def coerce_timestamp(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text that is no date becomes null; fractions of a second are cut."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: cut_to_second(F.col(c)) if types[c] == "timestamp_ntz" else parse_timestamp(F.col(c))
            for c in columns
            if c in types
        }
    )


def _coerced(name: str, raw: DataFrame, late: Mapping[str, Column] | None) -> DataFrame:
    """A clean table, and whether a row's key is spelled otherwise than where it was made unique."""
    rules = RULES[name]
    unique = dedup_keep_first(raw, rules.key, late=late)
    coerced = coerce_timestamp(coerce_numeric(unique, rules.money), rules.timestamps)
    # Columns without a rule of their own take the declared type.
    columns = {
        f.name: F.col(f.name)
        if f.name in rules.money + rules.timestamps
        else F.col(f.name).try_cast(f.dataType)
        for f in RAW[name]
    }
    types = dict(coerced.dtypes)
    respelled = [
        ~F.col(k).cast("string").eqNullSafe(columns[k].cast("string"))
        for k in rules.key
        if types[k] != RAW[name][k].dataType.simpleString()
    ]
    rekeyed = reduce(or_, respelled, F.lit(False)).alias(_REKEYED)
    return coerced.select(*(column.alias(c) for c, column in columns.items()), rekeyed)


def clean_table(
    name: str, raw: DataFrame, late: Mapping[str, Column] | None = None
) -> DataFrame:
    """``late`` gives columns of ``raw`` by its source position, as ``dedup_keep_first`` takes them."""
    return _coerced(name, raw, late).drop(_REKEYED)


def clean_and_count(
    name: str, raw: DataFrame, late: Mapping[str, Column] | None = None
) -> tuple[DataFrame, Callable[[DataFrame], Measured | None]]:
    """``clean_table`` with the counts of its checks, which are taken while it is written."""
    watched, measured = watch(_coerced(name, raw, late), name, F.col(_REKEYED))
    return watched.drop(_REKEYED), measured


def fact_order_item_sales(
    items: DataFrame, orders: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    """Items with purchase time, English category and revenue; every item is kept.

    The category is resolved on the product table first, so the items are shuffled once per key
    instead of once more for the category. The joins use different keys, so each has an exchange of
    its own and adaptive execution can split a hot key on the item side. Orders come last, so the rows
    are left in the order of theirs and those of an order, which are alike, are stored side by side. A null
    category matches a null translation.
    """
    category = products.join(
        translation,
        products.product_category_name.eqNullSafe(translation.product_category_name),
        "left",
    ).select("product_id", "product_category_name_english")
    return (
        items.join(category, "product_id", "left")
        .join(orders.select("order_id", "order_purchase_timestamp"), "order_id", "left")
        .withColumn("revenue", F.col("price") + F.col("freight_value"))
        .select(*ITEM_SALES.fieldNames())
    )
