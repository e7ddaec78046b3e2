"""Order reports kept current by partial counts and sums per month.

The figures of the monthly, delivery and weekday reports are counts and exact sums over delivered orders, so
they add up over any division of the orders. Per month of the order fact a few rows are stored, one for
every delivery status and weekday that occurs; a refresh counts only the months that its upsert wrote anew
and takes the others' rows from the version before. A report then reads these rows, whose number
follows the months and not the orders.

Top categories count an order once for each category and join three tables, and repeat customers need
every customer's orders; neither adds up over months, so these two read the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.columns import day_type
from tradewind.operators.upsert import PARTITION, MonthlyTable
from tradewind.plans.reports import growth_pct, read_orders
from tradewind.schemas import MONEY_SUM
from tradewind.session import file_system

DAYS_SUM = T.DecimalType(38, 8)
#: Name of a sum: the column of the extract, the type it is summed as, the type of the sum.
SUMMED = {
    "revenue": ("order_revenue", MONEY_SUM, MONEY_SUM),
    "review": ("review_score", T.DoubleType(), T.DoubleType()),
    "late": ("is_late_delivery", T.LongType(), T.LongType()),
    "delay": ("delivery_delay_days", T.DecimalType(20, 8), DAYS_SUM),
}
KEYS = ("order_month", "delivery_status", "order_weekday")
PARTS = T.StructType(
    [T.StructField(name, T.StringType()) for name in (PARTITION, *KEYS)]
    + [T.StructField("orders", T.LongType())]
    + [
        field
        for name, (_, _, total) in SUMMED.items()
        for field in (T.StructField(f"{name}_sum", total), T.StructField(f"{name}_count", T.LongType()))
    ]
)


def order_parts(rows: DataFrame) -> DataFrame:
    """Partial counts and sums of delivered orders, from rows of the order fact with their month."""
    extract = read_orders(rows.where(F.col("is_delivered") == 1), PARTITION)
    figures = [F.count("*").alias("orders")]
    for name, (column, summed, total) in SUMMED.items():
        figures.append(F.sum(F.col(column).cast(summed)).cast(total).alias(f"{name}_sum"))
        figures.append(F.count(column).alias(f"{name}_count"))
    return extract.groupBy(PARTITION, *KEYS).agg(*figures).select(*PARTS.fieldNames())


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """The partial sums at a path; None if no write there was completed."""
    files, where = file_system(spark, f"{path}/_SUCCESS")
    return spark.read.schema(PARTS).parquet(path) if files.exists(where) else None


def refresh_parts(old: DataFrame | None, fact: MonthlyTable, path: str) -> DataFrame:
    """Partial sums of a fact at a fresh path.

    ``old`` holds those of the version that the fact was upserted from; the months the upsert wrote are
    counted, the others copied. Without ``old``, or for a fact that no upsert gave, all are counted.
    """
    rows = fact.rows()
    if old is None or fact.changed is None:
        parts = order_parts(rows)
    else:
        # Months are given as literals, so no other month of the fact is opened.
        changed = F.col(PARTITION).isin(sorted(fact.changed))
        parts = old.where(~changed).unionByName(order_parts(rows.where(changed)))
    # A few rows a month, so one file holds them.
    parts.coalesce(1).write.mode("overwrite").parquet(path)
    return fact.spark.read.schema(PARTS).parquet(path)


# --- reports --------------------------------------------------------------------------------------


def _total(name: str) -> Column:
    return F.sum(f"{name}_sum").cast(SUMMED[name][2])


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum").cast("double"), F.sum(f"{name}_count"))


def _orders() -> Column:
    return F.sum("orders").alias("total_orders")


def monthly_kpi(parts: DataFrame) -> DataFrame:
    """As the report of that name over all orders."""
    months = (
        parts.where(F.col("order_month").isNotNull())
        .groupBy("order_month")
        .agg(
            _orders(),
            _total("revenue").alias("total_revenue"),
            _mean("revenue").alias("avg_order_value"),
            _mean("review").alias("avg_review_score"),
            _mean("late").alias("late_delivery_rate"),
        )
    )
    previous = F.lag("total_revenue").over(Window.orderBy("order_month"))
    growth = growth_pct(F.col("total_revenue"), previous)
    return months.withColumn("mom_revenue_growth_pct", growth).orderBy("order_month")


def delivery_review(parts: DataFrame) -> DataFrame:
    """As the report of that name over all orders."""
    return (
        parts.where(F.col("delivery_status").isNotNull())
        .groupBy("delivery_status")
        .agg(
            _orders(),
            _mean("review").alias("avg_review_score"),
            _mean("delay").alias("avg_delivery_delay_days"),
            _mean("revenue").alias("avg_order_value"),
        )
        .orderBy(F.col("total_orders").desc(), "delivery_status")
    )


def weekday_weekend(parts: DataFrame) -> DataFrame:
    """As the report of that name over all orders."""
    return parts.groupBy(day_type(F.col("order_weekday")).alias("day_type")).agg(
        _orders(),
        _total("revenue").alias("total_revenue"),
        _mean("revenue").alias("avg_order_value"),
        _mean("review").alias("avg_review_score"),
    )


def summaries(parts: DataFrame) -> dict[str, DataFrame]:
    """The reports by the name of their file."""
    return {
        "monthly_kpi": monthly_kpi(parts),
        "delivery_review_analysis": delivery_review(parts),
        "weekday_vs_weekend": weekday_weekend(parts),
    }
