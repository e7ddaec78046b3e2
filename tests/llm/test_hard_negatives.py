from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def by_hand(rows, asks, positives=5, negatives=10):
    """All pairs, in whole numbers."""
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(256 * x) for x in vector], label))
    out = []
    for i, (a, va, la) in enumerate(kept):
        if not asks(a):
            continue
        scored = [
            (-sum(x * y for x, y in zip(va, v)), math.inf if b is None else b, b, la == label)
            for j, (b, v, label) in enumerate(kept) if j != i
        ]
        scored.sort(key=lambda s: s[:2])
        for score, _, b, _ in [s for s in scored if s[3]][:positives]:
            fits = [s for s in scored if not s[3] and 30 * -score <= 100 * -s[0] <= 90 * -score]
            out += [(a, b, n, c, -score, -s) for n, (s, _, c, _) in enumerate(fits[:negatives], 1)]
    return Counter(out)


def mined(spark, rows, asks, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("row", "place", "code", "whole", "low", "anchor", "score"):
        df = df.withColumn(name, F.lit("x"))
    return Counter(tuple(r[c] for c in NAMES) for r in H.mine(df, asks, **options).collect())


def clustered(n, size, labels, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, size))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        vector = centres[int(rng.integers(labels))] * rng.uniform(0, 1) + rng.normal(size=size) * 0.7
        rows.append((i, (vector / np.linalg.norm(vector)).tolist(), label))
    return rows


@pytest.mark.parametrize("size,cell", [(64, 4096), (24, 37), (100, 150)])
def test_equals_all_pairs(spark, size, cell):
    """Other lengths of vectors, and cells much smaller than the table."""
    rows = clustered(400, size, 4, size)
    got = mined(spark, rows, F.col("vec_id") % 20 == 0, cell=cell)
    assert got == by_hand(rows, lambda i: i % 20 == 0) and len(got) > 300


def test_intervals_hold_every_score():
    rng = np.random.default_rng(3)
    left = rng.integers(-300, 300, (40, 64))
    right = np.concatenate([rng.integers(-300, 300, (200, 64)), left[:5], -left[5:9], np.zeros((2, 64), np.int64)])
    code, along, rest, norm = H.encode(right)
    estimate, half = H.Anchors(left).intervals(slice(None), code, along, rest, norm)
    exact = left @ right.T
    assert (np.abs(exact - estimate) <= half).all()
    # Not for want of width: the interval is narrower than the scores' own bound.
    assert half[:, :200].mean() < 0.7 * (np.linalg.norm(left, axis=1)[:, None] * norm[:200]).mean()
    assert np.allclose(H.rotated(left) @ H.rotated(right).T, exact)


def test_odd_rows(spark):
    """Nulls, numbers that are not finite, ties, repeated rows, zero, short and opposite vectors, no id."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.9, 0.4], 1), (2, [0.9, 0.4], 1), (3, [0.5, 0.4], 2),
        (4, [0.5, 0.4], 2), (4, [0.5, 0.4], 3), (5, [0.0, 0.0], 2), (6, [-1.0, -0.5], 1), (7, [-0.5, -0.4], 2),
        (8, None, 1), (9, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 2), (12, [1.0, 0.5], None),
        (13, [0.6], 2), (14, [], 2), (None, [0.5, 0.4], 2), (None, [0.9, 0.4], 1), (20, [0.0, 0.0], 4), (21, [0.0, 0.0], 4),
        (30, [-0.3, 0.1], 5), (31, [0.3, -0.1], 5), (40, [0.2, 0.2], 9), (-10, [0.7, 0.7], 2), (15, [1e-9, -1e-9], 2),
    ]
    got = mined(spark, rows, F.col("vec_id") % 10 == 0, cell=5)
    assert got == by_hand(rows, lambda i: i is not None and i % 10 == 0)
    # A zero anchor scores zero with everything, which is the only score in its range.
    assert got[(20, 21, 1, -10, 0, 0)] == 1


def test_hot_label_and_copies(spark):
    """A third of all rows are copies of one vector, and nearly all share a label."""
    rows = clustered(300, 16, 2, 9)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, 1 if i % 7 else 2) for i, v, _ in rows]
    got = mined(spark, rows, F.col("vec_id") % 15 == 0, cell=64)
    assert got == by_hand(rows, lambda i: i % 15 == 0)


def test_no_rows_and_too_large(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.mine(empty, F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], SCHEMA)
    assert H.mine(alone, F.col("vec_id") % 10 == 0).count() == 0
    huge = spark.createDataFrame([(0, [1e12], 1)], SCHEMA)
    with pytest.raises(ValueError, match="64 bits"):
        H.mine(huge, F.col("vec_id") % 10 == 0)


def test_neither_side_is_broadcast(spark):
    rows = spark.createDataFrame(clustered(50, 8, 2, 1), SCHEMA)
    plan = H._search(
        *(H.materialize(rows.select(F.col("vec_id").alias("row"), F.lit(b"").alias("whole")), "side") for _ in "ab"),
        True, 5, 8,
    )._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Cartesian" not in plan and "WindowGroupLimit" in plan
