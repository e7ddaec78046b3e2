"""Order fact kept current from a folder that receives new files.

The same lookback and delete-and-insert as the batch refresh, once per micro-batch. The lookback is fixed
when a run starts, so what is applied does not depend on how the files fall into batches. Orders
older than it are not applied, as in the batch refresh, but kept in a table beside the fact.
A replayed micro-batch writes the same rows again, so the table stays right if the stream restarts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind.operators.dedup import dedup_keep_first
from tradewind.operators.upsert import at_time, lookback_start, read_monthly, since, upsert
from tradewind.plans import marts
from tradewind.plans.incremental import ORDERS_KEY, PURCHASED, fact_orders_of
from tradewind.plans.staging import stage
from tradewind.schemas import MARTS, RAW
from tradewind.session import materialize

#: Folder below the fact with the orders that came too late, one subfolder per micro-batch.
TOO_OLD = "_too_old"


def follow_orders(
    spark: SparkSession, inbox: str, details: Mapping[str, DataFrame], path: str, progress: str
) -> StreamingQuery:
    """Apply order files arriving in ``inbox`` to the fact at ``path`` and stop when all are read.

    ``details`` holds the staged customers, order_items, order_payments and order_reviews;
    ``progress`` is the checkpoint folder of the stream. Without a fact at ``path`` the first batch
    is its first build.
    """
    layout = MARTS["fact_orders"]
    begun = read_monthly(spark, path, layout)
    start = None if begun is None else lookback_start(begun, PURCHASED)
    tables = [details[n] for n in ("customers", "order_items", "order_payments", "order_reviews")]

    def apply(arrived: DataFrame, batch: int) -> None:
        orders = materialize(stage("orders", dedup_keep_first(arrived, ORDERS_KEY)), "arrived")
        target = read_monthly(spark, path, layout)
        if start is None:
            fresh = marts.fact_orders(orders, *tables)
        else:
            late = orders.where(F.col(PURCHASED).isNull() | (F.col(PURCHASED) < at_time(start)))
            late.write.mode("overwrite").parquet(f"{path}/{TOO_OLD}/batch={batch}")
            fresh = fact_orders_of(materialize(since(orders, PURCHASED, start), "recent"), *tables)
        upsert(target, path, fresh, ORDERS_KEY, "order_date")

    return (
        spark.readStream.schema(RAW["orders"])
        .parquet(inbox)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
