"""Staging projections, one per cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.schemas import RAW

# The raw files misspell two product columns.
RENAMED = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def stage(name: str, cleaned: DataFrame) -> DataFrame:
    """Declared columns of a cleaned table; items gain revenue, products get their spelling fixed."""
    staged = cleaned.select(*RAW[name].fieldNames())
    if name == "order_items":
        return staged.withColumn("revenue", F.col("price") + F.col("freight_value"))
    if name == "products":
        return staged.withColumnsRenamed(RENAMED)
    return staged
