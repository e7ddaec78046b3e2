from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer, models

from tradewind.llm import token_counts as T


def reference(vocabulary: T.Vocabulary) -> Tokenizer:
    """The public unigram tokenizer over the same pieces, scores and byte spelling."""
    pieces = [("<unk>", vocabulary.lowest)]
    if vocabulary.bytes:
        pieces += [(f"<0x{b:02X}>", vocabulary.lowest) for b in range(256)]
    return Tokenizer(models.Unigram(pieces + list(vocabulary.scores.items()), 0, vocabulary.bytes))


def expected(tokenizer, text):
    return len(tokenizer.encode(T.MARK + text.replace(" ", T.MARK)).ids) if text else 0


@pytest.fixture(scope="module")
def vocabulary():
    return T.load(T.default_path())


def test_query_equals_the_public_tokenizer(spark, folder, vocabulary):
    from tradewind.llm.queries import op4_token_counts

    tokenizer = reference(vocabulary)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op4_token_counts(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.n_chars) == (expected(tokenizer, texts[r.doc_id]), len(texts[r.doc_id]))


def test_odd_texts(vocabulary):
    tokenizer = reference(vocabulary)
    rng = random.Random(3)
    texts = ["", " ", "  ", "a", "\n", "a\nb\tc  d ", "漢字 😀é", "x" * 500, "the " * 300, "▁a▁▁b"]
    alphabet = "abcdeéßthn  \n😀漢~.,12"
    texts += ["".join(rng.choices(alphabet, k=rng.randrange(1, 80))) for _ in range(400)]
    for text in texts:
        assert vocabulary.count(text)[1] == expected(tokenizer, text), text


@pytest.mark.parametrize("spelled", [True, False])
@pytest.mark.parametrize("long", [4096, 0])
def test_ties_and_unknown_runs(spelled, long, monkeypatch):
    """Small whole-number scores make most paths tie."""
    monkeypatch.setattr(T, "LONG_WORD", long)
    rng = random.Random(7)
    for _ in range(60):
        pieces = {"".join(rng.choices("ab▁", k=rng.randrange(1, 4))): float(-rng.randrange(1, 4)) for _ in range(9)}
        vocabulary = T.Vocabulary(pieces, min(pieces.values()), spelled)
        tokenizer = reference(vocabulary)
        for _ in range(30):
            text = "".join(rng.choices("abcé ", k=rng.randrange(1, 14)))
            assert vocabulary.count(text)[1] == expected(tokenizer, text), (pieces, text)


def test_few_remembered_words(vocabulary, monkeypatch):
    """Forgetting changes nothing."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["the", "of", "tion", "xé", "heand", "q" * 90], k=30)) for _ in range(40)]
    want = [vocabulary.count(t) for t in texts]
    monkeypatch.setattr(T, "CACHE_WORDS", 2)
    fresh = T.Vocabulary(vocabulary.scores, vocabulary.lowest, True)
    assert [fresh.count(t) for t in texts] == want


def test_odd_rows(spark, vocabulary):
    two, one = vocabulary.count("the the")[1], vocabulary.count("the")[1]
    rows = [(1, None, "x"), (2, "", None), (3, "the the", "x"), (3, "the the", "x"), (None, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = T.token_counts(docs.withColumns({"score": docs["doc_id"], "found": docs["doc_id"], "a.b": docs["doc_id"]})).collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(1, 0), (2, 0), (3, two), (3, two), (None, one)]
    assert T.token_counts(docs.limit(0)).count() == 0
