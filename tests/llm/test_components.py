from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.llm import components as C


def test_hub_is_split(spark, monkeypatch):
    """A node with 400,000 neighbours, in plans whose joins are not broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    plans = []

    def stored(moved, least, whole=C._stored):
        if len(plans) < 2:
            # Run once here, since a written table does not show the plan that adaptive execution ended with.
            moved.collect()
            plans.append(moved._jdf.queryExecution().executedPlan().toString())
        return whole(moved, least)

    monkeypatch.setattr(C, "_stored", stored)
    try:
        hub = spark.range(400_000).select(F.lit(500_000).cast("long").alias("a"), F.col("id").alias("b"))
        chain = spark.range(600_000, 600_050).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        got = C.connected_components(hub.union(chain), "a", "b")
        counts = {r.component: r["count"] for r in got.groupBy("component").count().collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert counts == {0: 400_000, 600_000: 50}
    # The hub is the larger end of its edges, so it is the step over larger ends that meets it.
    assert "skew=true" in plans[1]
