"""Quantile buckets over a whole table without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import materialize

# monotonically_increasing_id() keeps the partition above these bits and counts rows below them.
_ROW_BITS = 33


def bucket_of_rank(rank: Column, total: Column, buckets: int) -> Column:
    """ntile bucket of a 0-based rank; the first ``total % buckets`` buckets hold one row more."""
    size = F.floor(total / F.lit(buckets))
    longer = total % buckets
    in_longer = longer * (size + 1)
    return (
        F.when(rank < in_longer, F.floor(rank / (size + 1)) + 1)
        .otherwise(longer + F.floor((rank - in_longer) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def global_ntile(
    df: DataFrame, buckets: int, order: Sequence[Column], output: str
) -> DataFrame:
    """``ntile(buckets) over (order by order)`` for a table of any size.

    ``ntile`` without a partition would pull every row into one task. Here rows are range
    partitioned and sorted on the full order, which must end in a unique column so that equal values
    can be split over tasks. The row number inside a task and the number of rows in earlier tasks
    give the global rank. The ranked rows are stored before they are counted, so both steps see the
    same split. Only one count per task is gathered and broadcast.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(
        ranged.withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftright("_at", _ROW_BITS))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_at"),
        f"ranked-{output}",
    )
    # One row per task of the previous step: small, whatever the size of the table.
    tasks = stored.groupBy("_task").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = tasks.select(
        "_task",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(everything).alias("_total"),
    )
    ranked = stored.join(F.broadcast(offsets), "_task")
    bucket = bucket_of_rank(F.col("_before") + F.col("_row"), F.col("_total"), buckets)
    return ranked.select(*df.columns, bucket.alias(output))
