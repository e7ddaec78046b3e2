from __future__ import annotations

import zlib

import numpy as np
import pytest

from tradewind.llm import language as L

SCHEMA = "doc_id long, text string, lang string, source string"


def test_query(spark, folder):
    from tradewind.llm.queries import op3_language_id

    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op3_language_id(spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert sum(right) / len(right) > 0.97
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1


def by_hand(text, space):
    """Bundle of one text, one n-gram at a time."""
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    codes = [ord(c) if c != " " else 0 for c in " " + " ".join(words) + " "]
    total = np.zeros(space.dimensions)
    for at in range(len(codes) - space.size + 1):
        vector = np.ones(space.dimensions)
        for place in range(space.size):
            one = L.letter_vectors(np.array([codes[at + place]]), space)[0]
            vector *= np.roll(one, space.size - 1 - place)
        total += vector
    return total


def test_bundles_equal_the_definition(monkeypatch):
    space = L.Space(dimensions=192, size=3)
    texts = ["Ab, ba!  ÉA\n b", "a", "zz zz zz", "語 かな 1 x"]
    monkeypatch.setattr(L, "CHUNK_GRAMS", 4)
    monkeypatch.setattr(L, "CHUNK_LETTERS", 5)
    got = L.bundle([L.grams(t, 3) for t in texts], space)
    for row, text in zip(got, texts, strict=True):
        assert np.array_equal(row, by_hand(text, space))


def test_letter_vectors_are_nearly_orthogonal():
    rows = L.letter_vectors(np.arange(0, 2000), L.Space()).astype(float)
    cosines = rows @ rows.T / rows.shape[1]
    np.fill_diagonal(cosines, 0)
    assert abs(cosines).max() < 0.25


def test_odd_rows(spark):
    rows = [
        (1, "the cat and the hat", "en", "a"), (2, "der hund und die katze", "de", "a"),
        (3, None, "en", "a"), (4, "", "en", None), (5, "12 34 !!", "de", "b"), (6, "the the", None, "b"),
        (6, "the the", None, "b"), (None, "die die", None, None), (8, "und " * 50_000, None, "a"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = L.train(docs)
    assert model.names == ["de", "en"]
    got = L.identify(docs.withColumns({"score": docs["source"], "found": docs["doc_id"], "a.b": docs["doc_id"]}), model).collect()
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und", "und", "en", "en", "de", "de"]
    assert all((r.score == 0) == (r.lang_pred == "und") for r in got)
    # No learned language.
    blank = L.train(docs.where("doc_id > 90"))
    assert {r.lang_pred for r in L.identify(docs, blank).collect()} == {"und"}
    assert L.identify(docs.limit(0), model).count() == 0


def test_model_does_not_depend_on_partitions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one, many = L.train(docs.coalesce(1)), L.train(docs.repartition(7))
    assert one.names == many.names and np.array_equal(one.prototypes, many.prototypes)


@pytest.mark.parametrize("text,want", [("a", True), ("1 _", False), (None, False), ("é", True)])
def test_letters(text, want):
    assert L.has_letter(text) is want
    assert (len(L.grams(text, 3)[0]) > 0) is want
