"""Document fingerprints: weighted SimHash, and search within a Hamming radius by block tables.

A text's terms are its pairs of neighbouring words (a last word stands alone). Each occurrence votes on
64 signed bits with the term's hash, weighted by the term's length, as long terms say more than "of the";
bit i is set if the votes for it outweigh those against. The votes are sums of packed counters, two
bits to a 64-bit sum, so 32 sums replace 64, and Spark adds them up before any shuffle.

The search cuts the 64 bits into blocks. Two fingerprints within r bits agree on all but r blocks, so a
table per choice of the blocks that agree, keyed by their bits, brings every such pair together (Manku,
Jain and Das Sarma, 2007). More blocks mean more tables with longer keys; their number follows the
number of fingerprints so that a key holds few of them.
"""

from __future__ import annotations

from itertools import combinations
from math import comb, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import materialize

BITS = 64
_HALF = 32
_PAIR = (1 << _HALF) | 1
_MASK = (1 << _HALF) - 1


# --- fingerprints ---------------------------------------------------------------------------------


def terms(text: Column) -> Column:
    """Pairs of neighbouring words in order, repeats included; the last word has no partner."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")
    return F.arrays_zip(words.alias("a"), F.slice(words, 2, 1 << 30).alias("b"))


def _similar(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def likeness(a: str, b: str) -> Column:
    """Share of equal bits of two fingerprints, 0 to 1."""
    return _similar(F.col(a), F.col(b))


def hex_digits(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def simhash(rows: DataFrame, keys: list[str], texts: dict[str, str]) -> DataFrame:
    """One row per distinct ``keys`` with a signed 64-bit fingerprint per entry of ``texts``.

    ``texts`` maps the name of a fingerprint to the column of its text. Keys must tell the rows apart.
    Texts without a word have fingerprint zero. No shuffle is needed if the rows are already
    distributed by some of the keys.
    """
    versions = F.array(
        *(
            F.struct(F.lit(n).alias("n"), F.col(column).alias("text"))
            for n, column in enumerate(texts.values())
        )
    )
    each = rows.select(*keys, F.explode(versions).alias("v"))
    votes = each.select(*keys, "v.n", F.explode_outer(terms(F.col("v.text"))).alias("t"))
    hashed = votes.select(
        *keys,
        "n",
        F.xxhash64("t.a", "t.b").alias("hash"),
        # A row without any word must still come out, with no votes.
        F.coalesce(F.length("t.a") + F.coalesce(F.length("t.b"), F.lit(0)), F.lit(0)).cast("bigint").alias("weight"),
    )
    n = F.col("n")
    summed = hashed.groupBy(*keys, n).agg(
        F.sum("weight").alias("all"),
        *(
            F.sum(
                F.col("weight") * F.shiftrightunsigned("hash", i).bitwiseAND(F.lit(_PAIR))
            ).alias(f"v{i}")
            for i in range(_HALF)
        ),
    )
    bits = F.lit(0).cast("bigint")
    for i in range(_HALF):
        for half, votes_for in (
            (0, F.col(f"v{i}").bitwiseAND(F.lit(_MASK))),
            (_HALF, F.shiftrightunsigned(f"v{i}", _HALF)),
        ):
            bit = 1 << (i + half)
            bit = bit - (1 << BITS) if bit >> 63 else bit
            bits = bits.bitwiseOR(F.when(votes_for * 2 > F.col("all"), F.lit(bit)).otherwise(F.lit(0)))
    prints = summed.select(*keys, "n", bits.alias("print"))
    return prints.groupBy(*keys).agg(
        *(
            F.coalesce(F.max(F.when(F.col("n") == n, F.col("print"))), F.lit(0).cast("bigint")).alias(name)
            for n, name in enumerate(texts)
        )
    )


# --- neighbours in key order ----------------------------------------------------------------------


def with_next(docs: DataFrame, key: str, text: str, buckets: int | None = None) -> DataFrame:
    """``(bucket, place, guest, key, text, next_text)`` in ascending order of an integer key.

    ``next_text`` is the text of the following row, after the last that of the first; a null text is
    empty, a null key comes first, equal keys follow their texts. Rows are cut into buckets of
    consecutive keys at quantiles of the keys, as range partitioning does; ``guest`` rows are copies of
    the next bucket's first rows, there to be looked at only. The text is shuffled once. The
    broadcast table has as many rows as there are buckets, by default four per shuffle partition.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = -(1 << 63)
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(lowest)).alias("sort_key"),
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    shares = [i / buckets for i in range(1, buckets)]
    first = rows.agg(
        F.min("sort_key").alias("least"),
        F.percentile_approx("sort_key", shares or [0.5], 20 * buckets).alias("cuts"),
    ).first()
    if first["least"] is None:
        starts = [lowest]
    else:
        starts = sorted({first["least"], *first["cuts"]})
    # Bins of equal width lead from a key to the few buckets it may be in.
    width = max(1.0, (float(starts[-1]) - float(starts[0])) / len(starts))
    bin_of = lambda x: int((float(x) - float(starts[0])) / width)
    top = bin_of(starts[-1])
    ranges = []
    for b, start in enumerate(starts):
        stop = starts[b + 1] if b + 1 < len(starts) else None
        last = top if stop is None else bin_of(stop)
        ranges += [(i, b, start, stop) for i in range(bin_of(start), last + 1)]
    table = spark.createDataFrame(ranges, "bin long, bucket int, start long, stop long")
    column = F.least(
        ((F.col("sort_key").cast("double") - float(starts[0])) / width).cast("bigint"), F.lit(top)
    )
    placed = (
        rows.withColumn("bin", column)
        .join(F.broadcast(table), "bin")
        .where("sort_key >= start AND (stop IS NULL OR sort_key < stop)")
    )
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"), F.lit(0).alias("wrapped"))
    before = F.pmod(F.col("bucket") - 1, F.lit(len(starts)))
    wrapped = (F.col("bucket") == 0).cast("int")
    guest = F.struct(before.alias("bucket"), F.lit(True).alias("guest"), wrapped.alias("wrapped"))
    copies = F.when(F.col("sort_key") == F.col("start"), F.array(own, guest)).otherwise(F.array(own))
    spread = placed.select("sort_key", "key", "text", F.explode(copies).alias("c")).select(
        "c.*", "sort_key", "key", "text"
    )
    order = Window.partitionBy("bucket").orderBy("wrapped", "sort_key", "guest", "text")
    return spread.select(
        "*",
        F.row_number().over(order).alias("place"),
        F.lead("text").over(order).alias("next_text"),
    ).drop("wrapped")


def edited(text: str, next_text: str) -> Column:
    """The last quarter of the code points gives way to as many (or all) from the start of the next."""
    n = F.length(text)
    k = F.floor(n / 4).cast("int")
    return F.concat(F.substr(F.col(text), F.lit(1), n - k), F.substr(F.col(next_text), F.lit(1), k))


def with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and of the next text.

    Columns: the key, ``n_chars``, ``edited_sha256``, ``print``, ``edited_print``, ``next_print``; one
    row per row of ``docs``. An empty table gives an empty one.
    """
    paired = with_next(docs, key, text).withColumn("edited", edited("text", "next_text"))
    paired = paired.select(
        "bucket", "place", "guest", "key", "text", F.coalesce("edited", "text").alias("edited"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    digest = F.sha2("edited", 256)
    keys = ["bucket", "place", "guest", "key", "n_chars", "edited_sha256"]
    prints = simhash(
        paired.withColumn("edited_sha256", digest), keys, {"print": "text", "edited_print": "edited"}
    )
    order = Window.partitionBy("bucket").orderBy("place")
    return (
        prints.withColumn("next_print", F.lead("print").over(order))
        .where(~F.col("guest"))
        .select(
            F.col("key").alias(key), "n_chars", "edited_sha256", "print", "edited_print", "next_print"
        )
    )


# --- search ---------------------------------------------------------------------------------------


def _layout(n: int, radius: int, per_key: float = 4.0) -> tuple[int, int]:
    """Blocks, and how many of them form a key, for the fewest tables with short lists."""
    for agree in range(1, BITS - radius):
        blocks = radius + agree
        if BITS * agree // blocks >= log2(max(2, n / per_key)) or comb(blocks + 1, radius) > 500:
            return blocks, agree
    return BITS, BITS - radius


def within_radius(queries: DataFrame, stored: DataFrame, column: str, radius: int) -> DataFrame:
    """``(query, found, distance)`` for all distinct fingerprints within ``radius`` bits.

    Both tables hold signed 64-bit numbers in ``column``; nulls are ignored, equal fingerprints count
    once. Radius 0 to 8.
    """
    left = queries.select(F.col(column).alias("query")).dropna().distinct()
    right = materialize(stored.select(F.col(column).alias("found")).dropna().distinct(), "stored")
    blocks, agree = _layout(right.count(), radius)
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), agree):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        masks.append(mask - (1 << BITS) if mask >> 63 else mask)

    def tables(rows: DataFrame, name: str) -> DataFrame:
        keyed = F.array(
            *(
                F.struct(F.lit(i).alias("t"), F.col(name).bitwiseAND(F.lit(m)).alias("k"))
                for i, m in enumerate(masks)
            )
        )
        return rows.select(name, F.explode(keyed).alias("e")).select("e.t", "e.k", name)

    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("found")))
    near = tables(left, "query").join(tables(right, "found"), ["t", "k"]).where(distance <= radius)
    # A pair may agree in several tables; the first one reports it.
    differ = F.col("query").bitwiseXOR(F.col("found"))
    agreeing = F.filter(
        F.array(*(F.struct(F.lit(i).alias("t"), F.lit(m).alias("m")) for i, m in enumerate(masks))),
        lambda x: x["m"].bitwiseAND(differ) == 0,
    )
    return near.where(F.col("t") == F.element_at(agreeing, 1)["t"]).select(
        "query", "found", distance.alias("distance")
    )
