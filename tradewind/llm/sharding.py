"""Shards that all have the mixture of the whole: proportional stratified interleaving.

Rows of a stratum (a source) are shuffled by a seeded hash and ranked from 0; the fractional rank (rank
+ phase) / (rows of the stratum) spreads every stratum evenly over 0 to 1. The phase, a seeded number
from 0 to 1 per stratum, keeps strata of one size from falling on the same places. In the order of
the fractional rank any stretch holds the strata in their proportions, so cutting it into equal
stretches gives shards that match the mixture and differ by at most one row.

Neither ranking gathers a stratum, or everything, in one task: hashes and fractional ranks are both
uniform, so rows are cut into ranges of them, ranked within the range, and shifted by the counts of
the ranges before. Only keys, hashes and digests are shuffled, never texts.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import materialize

#: Rows per range wanted, and the most ranges; beyond them ranges grow instead.
RANGE_ROWS, MAX_RANGE_BITS = 1000, 16


def text_size(text: Column) -> Column:
    """UTF-8 bytes and one for the end; a null text has no bytes."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def _rank(rows: DataFrame, strata: list[str], part: str, order: list[str], name: str) -> DataFrame:
    """Rank from 0 within the strata by (part, order); ``part`` ascends with ``order``."""
    counts = rows.groupBy(*strata, part).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    earlier = earlier.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    within = Window.partitionBy(*strata, part).orderBy(*order)
    numbered = rows.withColumn("_nth", F.row_number().over(within) - 1)
    return numbered.join(shift, [*strata, part]).withColumn(
        name, (F.col("_nth") + F.col("_shift")).cast("long")
    ).drop("_nth", "_shift")


def interleave(
    docs: DataFrame,
    key: str = "doc_id",
    stratum: str = "source",
    text: str = "text",
    shards: int = 16,
    seed: int = 42,
) -> DataFrame:
    """``(key, stratum, size, text_crc32, shard, slot)`` per row of ``docs``.

    Shards are numbered from 0 and their row counts differ by at most one; ``slot`` numbers the rows of
    a shard from 0 without gaps. A null stratum is a stratum of its own; null texts count as empty.
    Rows that repeat in full are told apart by nothing and share their places in any order. With
    fewer rows than shards some shards stay empty; an empty table gives an empty one.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(key).alias("_key"),
            F.col(stratum).alias("_stratum"),
            F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")).alias("_group"),
            text_size(F.col(text)).alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.xxhash64(F.lit(seed), F.col(key), content).alias("_hash"),
        ),
        "shard-rows",
    )
    total = rows.count()
    bits = min(MAX_RANGE_BITS, max(1, ceil(log2(max(2, total / RANGE_ROWS)))))
    # Shifting the sign away makes unsigned order the order of the ranges.
    shuffled = rows.withColumns(
        {
            "_order": F.shiftrightunsigned("_hash", 1),
            "_range": F.shiftrightunsigned("_hash", 64 - bits),
        }
    ).withColumn("_order", F.struct("_order", "_hash", "_key", "size", "text_crc32"))
    ranked = _rank(shuffled, ["_group"], "_range", ["_order"], "_rank").drop("_range")
    sizes = rows.groupBy("_group").agg(F.count("*").alias("_rows"))
    phase = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_group"), 11) / F.lit(float(1 << 53))
    spread = ranked.join(sizes, "_group").withColumn(
        "_share", (F.col("_rank") + phase) / F.col("_rows")
    )
    spread = spread.withColumn("_range", F.floor(F.col("_share") * (1 << bits)))
    ordered = _rank(spread, [], "_range", ["_share", "_order", "_group"], "_place")
    whole = max(1, total)
    placed = ordered.withColumn("shard", F.expr(f"cast(_place * {shards} div {whole} as int)"))
    # Shard s holds the places p with p * shards div total = s, the first being s * total / shards, up.
    start = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return placed.select(
        F.col("_key").alias(key),
        F.col("_stratum").alias(stratum),
        "size",
        "text_crc32",
        "shard",
        (F.col("_place") - start).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within every file."""
    spread = sharded.repartition("shard", F.floor(F.col("slot") / 1_000_000))
    spread.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
