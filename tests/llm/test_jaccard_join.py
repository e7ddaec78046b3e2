from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind import session
from tradewind.llm import jaccard_join as J


def set_of(text, size=5):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    size = min(size, len(words))
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def by_hand(texts):
    """Root per place, by comparing all pairs."""
    sets = [set_of(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def check(spark, texts, **columns):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = J.near_duplicates(docs).collect()
    roots, sizes = by_hand(texts)
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(roots))
    assert {r.doc_id: r.n_shingles for r in got} == dict(enumerate(sizes))
    return roots


def edited(rng, words, edits, pool):
    words = list(words)
    for at in rng.choice(len(words), edits, replace=False).tolist():
        words[at] = str(rng.choice(pool))
    return " ".join(words)


@pytest.fixture(scope="module")
def near_copies():
    """Copies, edits on both sides of the limit, cuts, shared passages and unlike texts of all lengths."""
    rng = np.random.default_rng(11)
    pool = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(pool, 60))
    texts = []
    for k in range(40):
        words = rng.choice(pool, int(rng.integers(6, 200))).tolist()
        texts += [" ".join(words), " ".join(words).upper()]
        texts += [edited(rng, words, int(e), pool) for e in rng.integers(1, max(2, len(words) // 20), 3)]
        texts += [" ".join(words[: int(len(words) * share)]) for share in (0.78, 0.8, 0.84, 0.95)]
        texts += [passage + " " + " ".join(rng.choice(pool, int(rng.integers(1, 80)))) for _ in range(3)]
    return [texts[i] for i in rng.permutation(len(texts))]


def test_equals_all_pairs(spark, near_copies):
    roots = check(spark, near_copies)
    assert 100 < len(set(roots)) < 400


def test_many_small_blocks_and_cells(spark, near_copies, monkeypatch):
    """Limits so small that messages, column blocks, large groups, bands and block pairs all occur."""
    for name, value in (("SENT", 700), ("BLOCK", 300), ("CELL_ROWS", 8), ("CELL_SHINGLES", 2000), ("DENSE", 2), ("CHUNK", 64), ("DOCS", 5), ("TEXT", 40)):
        monkeypatch.setattr(J, name, value)
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    check(spark, near_copies)


def test_hot_groups(spark, monkeypatch):
    """A third are copies of one text, a third near copies of a hub that are not near each other, and all
    the rest share a passage longer than their own words."""
    monkeypatch.setattr(J, "CELL_ROWS", 64)
    rng = np.random.default_rng(5)
    pool = [f"w{i}" for i in range(500)]
    hub = rng.choice(pool, 250).tolist()
    passage = " ".join(rng.choice(pool, 50))
    texts = ["Copy of one text that many have"] * 150 + [" ".join(hub)]
    texts += [edited(rng, hub, 5, pool) for _ in range(150)]
    texts += [passage + " " + " ".join(rng.choice(pool, int(rng.integers(5, 60)))) for _ in range(150)]
    roots = check(spark, [texts[i] for i in rng.permutation(len(texts))])
    assert max(np.bincount(roots)) >= 150


def test_chains_of_sizes(spark, monkeypatch):
    """Every text is a prefix of the next, so links go from band to band."""
    monkeypatch.setattr(J, "CELL_ROWS", 16)
    words = [f"w{i}" for i in range(900)]
    lengths = [int(20 * 1.02**k) for k in range(190)]
    check(spark, [" ".join(words[:n]) for n in lengths])


def test_the_limit_itself(spark):
    """Overlap over union of exactly 0.8 links, a shingle less does not."""
    words = [f"w{i}" for i in range(104)]
    texts = [" ".join(words), " ".join(words[:84]), " ".join(words[:83]), "a b c d", "a b c d e", "A  b\tc\nd"]
    assert check(spark, texts) == [0, 0, 0, 3, 4, 3]
    assert check(spark, texts[:1] + texts[2:3]) == [0, 1]


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [
        (5, None), (3, ""), (9, " \t\r\n\x0b\x0c"), (1, "One"), (2, "oNE"), (4, long), (6, long + " x"), (7, "été"),
        (8, "ÉTÉ"), (7, "été"), (None, "One"), (None, None), (None, "alone here"), (10, "a b"), (11, "a b"), (12, "x " * 50_000), (13, "X"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("key", "id", "n", "component_id", "tokens", "hi", "grp"):
        docs = docs.withColumn(name, F.lit("x"))
    got = J.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = {5: 5, 3: 3, 9: 9, 1: 1, 2: 1, 4: 4, 6: 4, 7: 7, 8: 8, 10: 10, 11: 11, 12: 12, 13: 13}
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert sorted((str(r.component_id), r.n_shingles) for r in got if r.doc_id is None) == [("1", 1), ("None", 0), ("None", 1)]
    assert {r.doc_id: r.n_shingles for r in got if r.doc_id}[4] == 119_996
    assert J.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    names = spark.createDataFrame([("b", "One two"), ("a", "one two")], "name string, body string")
    assert {r.component_id for r in J.near_duplicates(names, id_col="name", text_col="body").collect()} == {"a"}


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    """By rows and by bytes, and the caller's settings are as before, also after a failure."""
    plain, keys = J._sets, list(session._BATCHES)
    rows, size = (session._BATCHES[f"spark.sql.execution.arrow.max{of}PerBatch"] for of in ("Records", "Bytes"))

    def watched(batches, words):
        def seen():
            for batch in batches:
                if len(batch) > rows or batch["text"].str.len().sum() > 2 * size:
                    raise ValueError(f"{len(batch)} rows in a batch")
                yield batch

        return plain(seen(), words)

    monkeypatch.setattr(J, "_sets", watched)
    text = F.when(F.col("id") < 1500, F.concat_ws(" ", F.lit("text"), "id")).otherwise(F.repeat(F.lit("word " * 40), 1000))
    docs = spark.range(0, 1560, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    before = [spark.conf.get(key, None) for key in keys]
    got = {r.doc_id: r.component_id for r in J.near_duplicates(docs).collect()}
    assert got == {i: min(i, 1500) for i in range(1560)}
    assert [spark.conf.get(key, None) for key in keys] == before
    with pytest.raises(KeyError), session.small_batches(spark):
        assert spark.conf.get(keys[1]) == str(rows)
        raise KeyError
    assert [spark.conf.get(key, None) for key in keys] == before
    # A caller's smaller batches stay.
    monkeypatch.setitem(session._BATCHES, keys[1], 20_000)
    with session.small_batches(spark):
        assert spark.conf.get(keys[1]) == (before[1] or "20000")


def test_product_equals_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 200))) for _ in range(60)]
    found = J.overlaps(sets)
    for i, j in combinations(range(60), 2):
        assert found[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_hashes_tell_shingles_apart():
    rng = np.random.default_rng(1)
    text = " ".join(str(x) for x in rng.integers(0, 9, 60_000))
    assert len(J.shingles(text, 5)) == len(set_of(text)) and len(J.shingles("a b c", 5)) == 1
    assert not set(J.shingles("a b", 5).tolist()) & set(J.shingles("b a", 5).tolist())
