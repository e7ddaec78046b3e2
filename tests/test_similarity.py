from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators import similarity
from tradewind.operators.similarity import nearest_within, semantic_lookup, semantic_upsert
from tradewind.operators.text_audit import question_key

LAYOUT = "{} bigint, vector array<float>"


def frame(spark, name, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in vectors]
    return spark.createDataFrame(rows, LAYOUT.format(name)).repartition(5)


def brute_force(queries, cache, threshold=0.10):
    found = {}
    for q, v in queries:
        best = None
        for c, w in sorted(cache):
            a, b = np.float32(v).astype(float), np.float32(w).astype(float)
            if not a.any() or not b.any():
                continue
            d = round(1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b), 9)
            if d < threshold and (best is None or d < best[1]):
                best = (c, d)
        if best:
            found[q] = best
    return found


def run(spark, queries, cache, **options):
    got = nearest_within(frame(spark, "query_id", queries), frame(spark, "cache_id", cache), **options)
    return {r.query_id: (r.cache_id, r.distance) for r in got.collect()}


def clustered(rng, n, groups=6, dims=8, noise=0.25):
    centres = rng.normal(size=(groups, dims))
    # One group holds a third of all vectors.
    group = np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, groups, n))
    return [(i, centres[g] + noise * rng.normal(size=dims)) for i, g in enumerate(group)]


@pytest.mark.parametrize("anchors,block", [(1, 8192), (1, 16), (7, 8192), (12, 10)])
def test_equals_brute_force(spark, anchors, block):
    rng = np.random.default_rng(anchors + block)
    cache, queries = clustered(rng, 150), clustered(rng, 120)
    queries += cache[:20]
    queries = [(i, v) for i, (_, v) in enumerate(queries)]
    got = run(spark, queries, cache, anchor_limit=anchors, block_rows=block)
    expected = brute_force(queries, cache)
    assert 20 <= len(expected) < len(queries)
    assert got.keys() == expected.keys()
    for q, (c, d) in expected.items():
        assert got[q][0] == c and got[q][1] == pytest.approx(d, abs=2e-9)


def test_random_directions(spark):
    """No structure to prune on: still exact."""
    rng = np.random.default_rng(5)
    cache = [(i, rng.normal(size=3)) for i in range(200)]
    queries = [(i, rng.normal(size=3)) for i in range(100)]
    got = run(spark, queries, cache, anchor_limit=16, block_rows=32)
    expected = brute_force(queries, cache)
    assert {q: c for q, (c, _) in got.items()} == {q: c for q, (c, _) in expected.items()}


def test_distance_at_the_threshold_is_a_miss(spark):
    cache = [(1, [1.0, 0.0])]
    # cos = 0.8, so the distance is 0.2.
    queries = [(1, [0.8, 0.6])]
    assert run(spark, queries, cache, threshold=0.2) == {}
    assert run(spark, queries, cache, threshold=0.2001)[1][0] == 1


def test_equal_distances_go_to_the_smaller_id(spark):
    cache = [(9, [1.0, 0.1]), (4, [1.0, -0.1]), (7, [1.0, 0.1])]
    assert run(spark, [(1, [1.0, 0.0])], cache)[1][0] == 4
    # Many copies of one vector count as one entry.
    copies = [(i, [0.0, 1.0]) for i in range(50, 10, -1)]
    assert run(spark, [(1, [0.0, 2.0])], copies, block_rows=4)[1] == (11, 0.0)


def test_empty_sides_and_zero_vectors(spark):
    some = [(1, [1.0, 0.0])]
    zero = [(2, [0.0, 0.0])]
    assert run(spark, some, []) == {}
    assert run(spark, [], some) == {}
    assert run(spark, zero, some + zero) == {}
    holes = [(3, [float("nan"), 1.0])]
    assert run(spark, some + [(9, holes[0][1])], holes + some) == {1: (1, 0.0)}


def test_repeated_queries_are_compared_once_and_all_answered(spark):
    cache = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    queries = [(i, [1.0, 0.05]) for i in range(300)] + [(900, [-1.0, 0.0])]
    got = run(spark, queries, cache, block_rows=10)
    assert got.keys() == set(range(300)) and {c for c, _ in got.values()} == {1}


def test_many_near_entries_in_one_block(spark):
    rng = np.random.default_rng(2)
    cache = [(i, [1.0, *(0.01 * rng.normal(size=3))]) for i in range(600)]
    queries = [(i, [1.0, *(0.01 * rng.normal(size=3))]) for i in range(500)]
    got = run(spark, queries, cache)
    expected = brute_force(queries, cache)
    assert {q: c for q, (c, _) in got.items()} == {q: c for q, (c, _) in expected.items()}


def test_lookup_lists_every_query(spark):
    cache = frame(spark, "cache_id", [(1, [1.0, 0.0]), (2, [0.0, 1.0])]).withColumn("sql", F.concat(F.lit("q"), "cache_id"))
    queries = frame(spark, "query_id", [(10, [2.0, 0.1]), (11, [1.0, 1.0])])
    got = {r.query_id: r for r in semantic_lookup(queries, cache).collect()}
    assert (got[10].verdict, got[10].sql) == ("hit", "q1")
    assert got[10].similarity == pytest.approx(1 - got[10].distance)
    assert (got[11].verdict, got[11].sql, got[11].distance) == ("miss", None, None)


def test_upsert_replaces_by_key_and_rejects_bad_sql(spark):
    def entries(rows):
        return spark.createDataFrame(rows, "question string, vector array<float>, sql string, position int")

    good = "SELECT * FROM fact_orders LIMIT {}"
    cache = entries([("old", [1.0], good.format(1), 0), ("kept", [2.0], good.format(2), 0)]).withColumn(
        "id", question_key(F.col("question"))
    )
    answers = entries(
        [
            (" OLD ", [3.0], good.format(3), 1),
            ("new", [4.0], good.format(4), 2),
            ("new", [5.0], good.format(5), 3),
            ("bad", [6.0], "DROP TABLE fact_orders", 4),
        ]
    )
    got = {r.question: (r.vector, r.sql) for r in semantic_upsert(cache, answers).collect()}
    assert got == {
        "kept": ([2.0], good.format(2)),
        " OLD ": ([3.0], good.format(3)),
        "new": ([5.0], good.format(5)),
    }


def test_two_levels_of_anchors(spark, monkeypatch):
    """The driver picks a square root of the anchors; a dense region gets no more inner ones than a task may
    hold, and vectors along few directions are compared by bounds first."""
    picked = []
    choose = similarity._anchors
    monkeypatch.setattr(similarity, "_anchors", lambda stored, wanted: picked.append(wanted) or choose(stored, wanted))
    rng = np.random.default_rng(8)
    cache, queries = clustered(rng, 300, dims=32, noise=0.1), clustered(rng, 150, dims=32, noise=0.1)
    queries = [(i, v) for i, (_, v) in enumerate(queries + cache[:40])]
    got = run(spark, queries, cache, anchor_limit=40, block_rows=9)
    expected = brute_force(queries, cache)
    assert picked == [7] and len(expected) >= 40
    assert {q: c for q, (c, _) in got.items()} == {q: c for q, (c, _) in expected.items()}


def test_collected_rows_follow_the_outer_anchors(spark, monkeypatch):
    """Nothing that passes through the driver has a row per cell."""
    from pyspark.sql.classic.dataframe import DataFrame

    sizes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: sizes.append(len(rows := collect(df))) or rows)
    rng = np.random.default_rng(4)
    cache = frame(spark, "cache_id", [(i, rng.normal(size=4)) for i in range(400)])
    asked = frame(spark, "query_id", [(i, rng.normal(size=4)) for i in range(50)])
    nearest_within(asked, cache, anchor_limit=100, block_rows=4)
    assert sizes and max(sizes) <= 10


@pytest.mark.parametrize("dims,directions", [(8, 8), (64, 3), (64, 64)])
def test_bounds_hold_and_are_tight_along_few_directions(dims, directions):
    rng = np.random.default_rng(dims + directions)
    basis = rng.normal(size=(directions, dims))
    make = lambda n: rng.normal(size=(n, directions)) @ basis + 0.05 * rng.normal(size=(n, dims))
    known, asked = make(200), make(50)
    known, asked = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (known, asked))
    bounds = similarity._Bounds(known)
    above = bounds.of(asked) - asked @ known.T
    assert above.min() > -1e-5
    assert (bounds.basis is None) == (dims == 8)
    if directions == 3:
        assert bounds.basis.shape[1] <= 3 and above.max() < 0.3


def test_copies_of_a_vector_do_not_grow_with_the_tables(spark, monkeypatch):
    """Small blocks grow before a vector meets more than a few of them, and visits leave a task once per query."""
    grids, visits, store = [], [], similarity.materialize

    def watched(df, label):
        stored = store(df, label)
        if label == "grid":
            grids.extend(max(r.cache_blocks, r.query_blocks) for r in stored.collect())
        if label == "visits":
            visits.append((stored.count(), stored.select("query_id", F.size("cells")).collect()))
        return stored

    monkeypatch.setattr(similarity, "materialize", watched)
    rng = np.random.default_rng(3)
    cache, queries = clustered(rng, 600), clustered(rng, 300)
    got = run(spark, queries, cache, anchor_limit=4, block_rows=5)
    assert {q: c for q, (c, _) in got.items()} == {q: c for q, (c, _) in brute_force(queries, cache).items()}
    assert grids and max(grids) == similarity._BLOCKS
    assert visits and visits[0][0] <= 2 * len(queries)
