from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
import xxhash

from tradewind.llm import fingerprints as P

MASK = (1 << 64) - 1


def xx(words):
    """Spark chains the hash of several columns through the seed and skips nulls."""
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed


def by_hand(text):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower()) if w]
    votes = [0] * 64
    for i, a in enumerate(words):
        term = words[i : i + 2]
        h = xx(term)
        for bit in range(64):
            votes[bit] += sum(map(len, term)) * (1 if h >> bit & 1 else -1)
    return sum(1 << b for b in range(64) if votes[b] > 0)


def edit(text, following):
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def check(rows, got):
    """``rows``: (id, text) in ascending order."""
    want = []
    for at, (i, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1] or ""
        text = text or ""
        changed = edit(text, following)
        a, b, c = by_hand(text), by_hand(changed), by_hand(following)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        want.append((i, len(text), sha, f"{a:016x}", f"{b:016x}", 1 - (a ^ b).bit_count() / 64, 1 - (a ^ c).bit_count() / 64))
    names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
    key = lambda t: tuple(map(str, t))
    assert sorted((tuple(r[c] for c in names) for r in got), key=key) == sorted(want, key=key)


def test_query_equals_brute_force(spark, folder):
    from tradewind.llm.queries import op2_document_fingerprints

    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    got = op2_document_fingerprints(spark, folder).collect()
    check([(d.doc_id, d.text) for d in docs], got)
    prints = [(r.doc_id, int(r.fingerprint, 16)) for r in got]
    for r in got:
        own = int(r.fingerprint, 16)
        near = {p for _, p in prints if (p ^ own).bit_count() <= 3}
        assert r.n_near == (len(near) if r.doc_id % 100 == 0 else None)


def test_query_keeps_the_rows_of_repeated_ids(spark, tmp_path):
    """Each row counts the neighbours of its own fingerprint; no row is multiplied or lost."""
    from tradewind.llm.queries import op2_document_fingerprints

    rows = [(100, "a text of some words"), (100, "another one, quite different from it"), (101, "third"), (None, "fourth"), (200, None), (200, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op2_document_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    prints = {int(r.fingerprint, 16) for r in got}
    for r in got:
        near = sum((p ^ int(r.fingerprint, 16)).bit_count() <= 3 for p in prints)
        assert r.n_near == (near if r.doc_id in (100, 200) else None)


def test_no_python_and_one_shuffle_of_the_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    df = P.with_edits(docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("buckets", [1, 2, 3, 40])
def test_odd_rows(spark, buckets, monkeypatch):
    from tradewind.llm import queries

    long = "wort " * 40_000
    rows = [(None, "no key at all here"), (-5, None), (2, ""), (3, "one"), (10**15, long), (10**15 + 1, "é " * 7), (2**62, "ß 😀😀 zz y")]
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string")
    docs = docs.withColumns({c: docs["text"] for c in ("bucket", "guest", "place", "print", "key", "n", "bin")})
    real = P.with_next
    monkeypatch.setattr(P, "with_next", lambda d, k, t: real(d, k, t, buckets))
    check(rows, queries.fingerprint_digest(P.with_edits(docs)).collect())
    assert queries.fingerprint_digest(P.with_edits(docs.limit(0))).count() == 0
    one = docs.where("doc_id = 3")
    check([(3, "one")], queries.fingerprint_digest(P.with_edits(one)).collect())


def test_repeated_keys_follow_their_texts(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "b b b b"), (2, "z")]
    got = P.with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(
        hashlib.sha256(edit(t, n).encode()).hexdigest() for (_, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True)
    )


@pytest.mark.parametrize("n,radius", [(1, 3), (60, 0), (60, 3), (900, 3), (900, 6)])
def test_block_tables_equal_all_pairs(spark, n, radius):
    rng = np.random.default_rng(n + radius)
    keys = [int(x) for x in rng.integers(0, 1 << 64, n, dtype=np.uint64)]
    for k in keys[: n // 2]:
        for bit in rng.integers(0, 64, rng.integers(0, 8)).tolist():
            k ^= 1 << bit
        keys.append(k)
    signed = [k - (1 << 64) if k >> 63 else k for k in keys]
    stored = spark.createDataFrame([(k,) for k in signed] + [(None,)], "f long")
    queries = stored.where("f % 3 = 0")
    got = [(r.query & MASK, r.found & MASK, r.distance) for r in P.within_radius(queries, stored, "f", radius).collect()]
    asked = {k & MASK for k in signed if k % 3 == 0 or k % -3 == 0}
    want = {(a, b, (a ^ b).bit_count()) for a in asked for b in set(keys) if (a ^ b).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_more_fingerprints_get_longer_keys():
    sizes = [P._layout(10**e, 3) for e in (3, 5, 7, 9)]
    bits = [64 * agree // blocks for blocks, agree in sizes]
    assert bits == sorted(bits) and bits[0] < bits[-1]
    assert all(blocks - agree == 3 for blocks, agree in sizes)
