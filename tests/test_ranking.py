from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import plan
from tradewind.operators.ranking import global_ntile


def both(df, buckets, order):
    """Distributed and built-in buckets side by side; the built-in one is the reference result."""
    ours = global_ntile(df, buckets, order, "ours")
    return ours.withColumn("theirs", F.ntile(buckets).over(Window.orderBy(*order)))


@pytest.mark.parametrize("rows", [0, 1, 3, 4, 5, 6, 9, 1003, 20000])
def test_equals_ntile(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") * 7919 % 101).alias("v")).repartition(7)
    got = both(df, 5, [F.col("v").desc(), F.col("id").asc()])
    assert got.count() == rows
    assert got.where("ours <> theirs").count() == 0


def test_one_value_for_a_third_of_the_rows_and_nulls(spark):
    v = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id"))
    df = spark.range(5000).select("id", v.alias("v"))
    for order in (F.col("v").asc_nulls_last(), F.col("v").desc_nulls_first()):
        assert both(df, 5, [order, F.col("id").asc()]).where("ours <> theirs").count() == 0


def test_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(10007).select("id", (F.col("id") % 13).alias("v"))
        got = both(df, 5, [F.col("v").asc(), F.col("id").asc()])
        assert got.where("ours <> theirs").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_never_gather_in_one_task(spark):
    df = spark.range(100).select("id")
    text = plan(global_ntile(df, 5, [F.col("id").asc()], "b"))
    # The only single-partition step counts tasks; the rows themselves are read and joined.
    assert "BroadcastHashJoin" in text
    assert "ntile" not in text
