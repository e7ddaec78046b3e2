from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
import xxhash

from tradewind.llm import simhash_dedup as S

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, max_bits):
    """Smallest id reachable, by comparing all pairs."""
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in combinations(prints, 2):
        if (a ^ b).bit_count() <= max_bits:
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in prints}


def test_query_equals_brute_force(spark, folder):
    from tradewind.llm.queries import op10_simhash_near_dedup

    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    prints = [(d.doc_id, by_hand(d.text)) for d in docs]
    want = components(prints, 4)
    got = op10_simhash_near_dedup(spark, folder).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints}
    assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("max_bits,task_size", [(0, 1000), (3, 1000), (4, 40), (4, 7), (9, 60)])
def test_links_equal_all_pairs(spark, max_bits, task_size):
    """Clustered and random keys; small tasks force the distributed walk to go deep."""
    rng = np.random.default_rng(max_bits)
    centres = rng.integers(0, 1 << 64, 20, dtype=np.uint64)
    keys = set(rng.integers(0, 1 << 64, 60, dtype=np.uint64).tolist())
    for c in centres.tolist():
        for _ in range(12):
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                c ^= 1 << bit
            keys.add(c)
    signed = [k - (1 << 64) if k >> 63 else k for k in sorted(keys)]
    found = spark.createDataFrame([(k,) for k in signed], "f long")
    edges = S.links(found, "f", max_bits, task_size)
    roots = {r.node: r.component for r in S.connected_components(edges, "a", "b").collect()}
    mask = (1 << 64) - 1
    want = components([(k, k & mask) for k in signed], max_bits)
    assert {k: roots.get(k, k) for k in signed} == want


def test_trie_finds_every_pair_on_some_rotation():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, 4, False).astype(np.uint64)) for _ in base])
    keys = np.unique(np.concatenate([base, base ^ flips]))
    want = {(a, b) for a, b in combinations(keys.tolist(), 2) if (a ^ b).bit_count() <= 4}
    got = set()
    for turn in range(0, 64, 8):
        ring = np.unique((keys << np.uint64(turn)) | (keys >> np.uint64((64 - turn) % 64))) if turn else keys
        for i, j in S.trie_links(ring, None, 0, 0, 4):
            for a, b in zip(ring[i].tolist(), ring[j].tolist(), strict=True):
                back = [(x >> turn | x << (64 - turn)) & (1 << 64) - 1 for x in (a, b)]
                got.add((min(back), max(back)))
    assert got == want


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (5, None, None, None, None), (3, "", "en", "a", 0), (9, " \t\n", None, "a", 3),
        (1, "One", "en", "a", 3), (2, "oNE", "en", "a", 3), (4, long, "en", "a", 1), (6, long + " x", "en", "a", 1),
        (7, "été", "fr", "b", 3), (8, "ÉTÉ", "fr", "b", 3), (7, "été", "fr", "b", 3), (None, "One", "en", "a", 3),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    # Columns named like the operator's own change nothing.
    for name in ("fingerprint", "component_id", "ring", "rotation", "a", "hi"):
        docs = docs.withColumn(name, docs["source"])
    got = S.near_duplicates(docs).collect()
    component = {r.doc_id: r.component_id for r in got}
    assert len(got) == len(rows)
    assert component == {5: 3, 3: 3, 9: 3, 1: 1, 2: 1, None: 1, 4: 4, 6: 4, 7: 7, 8: 8}
    assert {r.doc_id: r.fingerprint for r in got}[9] == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(empty).count() == 0


def test_hot_groups(spark):
    """A third of all rows are copies of one text, another third are near copies of each other."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(400)]
    make = lambda n: " ".join(rng.choice(words, n))
    copy, base = make(80), make(300).split()
    rows = [(i, copy) for i in range(0, 600, 3)]
    for i in range(1, 600, 3):
        near = list(base)
        near[int(rng.integers(0, 300))] = str(rng.choice(words))
        rows.append((i, " ".join(near)))
    rows += [(i, make(int(rng.integers(1, 120)))) for i in range(2, 600, 3)]
    want = components([(i, by_hand(t)) for i, t in rows], 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    for task_size in (30, 100_000):
        got = S.near_duplicates(docs, task_size=task_size).collect()
        assert {r.doc_id: r.component_id for r in got} == want
    kept = S.one_per_group(docs, S.near_duplicates(docs)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_one_per_group_prefers_the_smallest_text_of_an_id(spark):
    rows = [(1, "same text here", "b"), (1, "same text here", "a"), (2, "same text here", "c"), (None, "z", "d"), (None, "z", "d"), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = S.one_per_group(docs, S.near_duplicates(docs)).collect()
    assert sorted(map(str, (tuple(r) for r in kept))) == sorted(map(str, [(1, "same text here", "a"), (3, None, None), (None, "z", "d"), (None, "z", "d")]))
