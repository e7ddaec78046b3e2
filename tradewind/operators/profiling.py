"""Table profiling: shape, gaps, value counts, join coverage and grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tradewind.functions.columns import count_where, mean_exact, round_half_up, share_pct
from tradewind.functions.columns import missing as is_missing
from tradewind.operators.quality import union_all
from tradewind.schemas import MONEY_SUM
from tradewind.session import materialize


def overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and fully repeated rows per table; equal rows meet in the partial aggregate."""

    def one(name: str, df: DataFrame) -> DataFrame:
        copies = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
        return copies.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        ).select(
            F.lit(name).alias("dataset"),
            "rows",
            F.lit(len(df.columns)).alias("columns"),
            "duplicates",
        )

    return union_all([one(name, df) for name, df in tables.items()])


def missing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns with nulls: count and percent. One scan per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        totals = df.agg(
            F.count("*").alias("rows"),
            *(count_where(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)),
        )
        gaps = F.array(
            *(
                F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("missing_count"))
                for i, c in enumerate(df.columns)
            )
        )
        return totals.select(F.lit(name).alias("dataset"), "rows", F.explode(gaps).alias("g"))

    found = union_all([one(name, df) for name, df in tables.items()]).select(
        "dataset", "rows", "g.*"
    )
    return (
        found.where(F.col("missing_count") > 0)
        .withColumn("missing_pct", share_pct(F.col("missing_count"), F.col("rows")))
        .select("dataset", "column", "missing_count", "missing_pct")
        .orderBy("dataset", F.col("missing_count").desc(), "column")
    )


def value_counts(df: DataFrame, column: str, output: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias(output))
        .orderBy(F.col(output).desc(), column)
    )


def score_counts(reviews: DataFrame) -> DataFrame:
    score = F.col("review_score").try_cast("double").alias("review_score")
    scores = reviews.select(score)
    return value_counts(scores, "review_score", "reviews").orderBy("review_score")


def histogram(df: DataFrame, column: str, bins: int = 5) -> DataFrame:
    """Equal-width bins over min..max, the last one closed; empty bins are listed with zero rows.

    Values are counted first and stored, so the table is read once and the bounds and bins come
    from one row per distinct value.
    """
    values = materialize(
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count("*").alias("rows")),
        "values",
    )
    span = values.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).where(
        F.col("lo").isNotNull()
    )
    # All values equal: the bins cover one unit around the value.
    single = F.col("lo") == F.col("hi")
    edges = span.select(
        F.when(single, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(single, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    grid = edges.select(
        "lo", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    slot = F.least(
        F.floor(
            (F.col("value") - edges.select("lo").scalar()) / edges.select("width").scalar()
        ).cast("int"),
        F.lit(bins - 1),
    )
    counts = values.groupBy(slot.alias("bin")).agg(F.sum("rows").alias("n"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("reviews"),
    )


def untranslated(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products without an English category. Categories are counted before the join."""
    return (
        products.groupBy("product_category_name")
        .agg(F.count("*").alias("n"))
        .join(translation, "product_category_name", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_products"),
            F.coalesce(
                F.sum(F.when(F.col("product_category_name_english").isNull(), F.col("n"))), F.lit(0)
            ).alias("untranslated"),
        )
        .withColumn("untranslated_pct", share_pct(F.col("untranslated"), F.col("total_products")))
    )


def join_sanity(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
) -> DataFrame:
    """Row count after joining everything to the items, null keys, and partners not found.

    Items are first counted per key combination that matters, orders find their customers in a join
    of their own, and products and sellers are met by counts per key.
    """

    def known(df: DataFrame, key: str) -> DataFrame:
        return df.select(key, F.lit(True).alias(f"has_{key}"))

    placed = orders.select("order_id", "customer_id").join(
        known(customers, "customer_id"), "customer_id", "left"
    )
    per_order = items.groupBy("order_id").agg(F.count("*").alias("n"))
    by_order = per_order.join(placed.withColumn("has_order", F.lit(True)), "order_id", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("merged_rows"),
        _weighted(F.col("order_id").isNull()).alias("null_order_id"),
        _weighted(F.col("customer_id").isNull()).alias("null_customer_id"),
        _weighted(F.col("has_order").isNull()).alias("orders_not_found"),
        _weighted(F.col("has_customer_id").isNull()).alias("customers_not_found"),
    )

    def by_key(key: str, lookup: DataFrame, label: str) -> DataFrame:
        counts = items.groupBy(key).agg(F.count("*").alias("n"))
        return counts.join(known(lookup, key), key, "left").agg(
            _weighted(F.col(key).isNull()).alias(f"null_{key}"),
            _weighted(F.col(f"has_{key}").isNull()).alias(f"{label}_not_found"),
        )

    def long(totals: DataFrame) -> DataFrame:
        pairs = F.array(
            *(F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in totals.columns)
        )
        return totals.select(F.explode(pairs).alias("p")).select("p.*")

    return union_all(
        [
            long(by_order),
            long(by_key("product_id", products, "products")),
            long(by_key("seller_id", sellers, "sellers")),
        ]
    )


def _weighted(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def grain(flat: DataFrame) -> DataFrame:
    """Rows, orders and customers of the item table.

    Two distinct counts in one aggregate would copy every row, so they are taken apart, each from
    the columns it needs.
    """
    sizes = flat.groupBy("order_id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("order_id").alias("unique_orders"),
    )
    people = flat.agg(F.count_distinct("customer_unique_id").alias("unique_customers"))
    return sizes.select(
        "total_rows",
        "unique_orders",
        people.scalar().alias("unique_customers"),
        round_half_up(
            F.try_divide(F.col("total_rows").cast("double"), F.col("unique_orders"))
        ).alias("avg_rows_per_order"),
    )


FIRST_OF_ORDER: tuple[str, ...] = (
    "order_purchase_timestamp",
    "order_month",
    "order_weekday",
    "customer_unique_id",
    "order_status",
    "review_score",
    "delivery_status",
    "delivery_delay_days",
)


def order_level_rollup(flat: DataFrame, first: Sequence[str] = FIRST_OF_ORDER) -> DataFrame:
    """Per order: the first non-null value by item number, whether delivered or late, revenue.

    Text columns of ``first`` are attributes of the order, equal on all its items, and are grouped by:
    an aggregate that carries text would sort all items.
    """
    texts = [c for c in first if isinstance(flat.schema[c].dataType, StringType)]

    def first_known(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("order_item_id"))).alias(name)

    per_order = flat.groupBy("order_id", *texts).agg(
        *(first_known(c) for c in first if c not in texts),
        F.max("is_delivered").alias("is_delivered"),
        F.max("is_late_delivery").alias("is_late_delivery"),
        F.sum("revenue").cast(MONEY_SUM).alias("order_revenue"),
    )
    return per_order.select("order_id", *first, "is_delivered", "is_late_delivery", "order_revenue")


def headline_kpis(flat: DataFrame, orders: DataFrame) -> DataFrame:
    """One row of key figures: delivered orders from the rollup, missing reviews from the items."""
    gaps = flat.agg(
        F.try_divide(
            count_where(F.col("review_score").isNull()).cast("double"), F.count("*")
        ).alias("rate")
    )
    return (
        orders.where(F.col("is_delivered") == 1)
        .agg(
            F.count("order_id").alias("delivered_orders"),
            F.sum("order_revenue").cast(MONEY_SUM).alias("delivered_revenue"),
            mean_exact(F.col("order_revenue")).alias("aov"),
            mean_exact(F.col("review_score")).alias("review"),
            mean_exact(F.col("is_late_delivery")).alias("late"),
        )
        .select(
            "delivered_orders",
            "delivered_revenue",
            round_half_up(F.col("aov")).alias("avg_order_value"),
            round_half_up(F.col("review"), 4).alias("avg_review_score"),
            round_half_up(F.col("late"), 4).alias("late_delivery_rate"),
            round_half_up(gaps.scalar(), 4).alias("missing_review_rate"),
        )
    )


def grain_bias(flat: DataFrame, orders: DataFrame) -> DataFrame:
    """The same two means over item rows and over delivered orders."""

    def means(df: DataFrame, label: str) -> DataFrame:
        totals = df.agg(
            mean_exact(F.col("review_score")).alias("review"),
            mean_exact(F.col("is_late_delivery")).alias("late"),
        )
        return totals.select(
            F.explode(
                F.array(
                    F.struct(F.lit("avg_review_score").alias("metric"), F.col("review").alias(label)),
                    F.struct(F.lit("late_delivery_rate").alias("metric"), F.col("late").alias(label)),
                )
            ).alias("m")
        ).select("m.*")

    # Two rows on each side.
    return means(flat, "item_level").join(
        means(orders.where(F.col("is_delivered") == 1), "order_level_delivered"), "metric"
    )
