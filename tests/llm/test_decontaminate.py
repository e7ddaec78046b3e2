from __future__ import annotations

import random

import numpy as np
import pytest

from tradewind.llm import decontaminate as D


def distance(pattern, text):
    """Fewest edits between the pattern and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j - 1] + (p != t), last[j] + 1, row[j - 1] + 1))
    return min(row)


def fold(text):
    return "".join(map(chr, D.folded(text)[0]))


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", text[at] + "q", "z"]) + text[at + 1 :]
    return text


def test_query_equals_brute_force(spark, folder):
    from tradewind.llm.queries import op1_benchmark_decontamination

    rules = D.Rules()
    items = [(r.item_id, fold(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = [(r.doc_id, fold(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.edits for r in op1_benchmark_decontamination(spark, folder).collect()}
    verbatim = {(d, i) for d, t in docs for i, p in items if p in t}
    assert verbatim == {k for k, e in got.items() if e == 0} and verbatim
    short = [x for x in docs if len(x[1]) < 800][:25]
    some = [i for i in items if any(k[1] == i[0] for k in got)][:5]
    for d, text in short:
        for i, passage in some:
            edits = distance(passage, text)
            assert got.get((d, i)) == (edits if edits <= rules.edits(len(passage)) else None)


@pytest.mark.parametrize("window", [64, 1 << 18])
def test_edited_passages_equal_brute_force(window, monkeypatch):
    monkeypatch.setattr(D, "WINDOW", window)
    rng = random.Random(window)
    words = ["the", "of", "than", "ered", "on", "ing", "tion", "a", "heand"]
    make = lambda n: " ".join(rng.choices(words, k=n))
    items = [make(rng.randrange(8, 40)) for _ in range(12)]
    index = D.Index(list(range(12)), items, D.Rules())
    found = 0
    for _ in range(120):
        pick = rng.randrange(12)
        text = make(rng.randrange(0, 60)) + " " + edited(rng, items[pick], rng.randrange(0, 22)) + " " + make(9)
        got = {i: hit[0] for i, hit in index.leaks(text).items()}
        want = {}
        for i, item in enumerate(items):
            edits = distance(fold(item), fold(text))
            if edits <= D.Rules().edits(len(fold(item))):
                want[i] = edits
        assert got == want
        found += len(want)
    assert found > 30


def test_places_and_long_passages():
    rng = random.Random(1)
    passage = "".join(rng.choices("abcdefgh ", k=3000))
    index = D.Index(["x"], [passage], D.Rules())
    text = "É! " * 10 + passage.upper().replace(" ", "\n-- ")[:2500]
    edits, start, end = index.leaks(text)["x"]
    assert edits == 0
    stretch = fold(text[start:end])
    assert stretch in fold(passage) and len(stretch) > 400
    assert index.leaks(passage[:200]) == {}


def test_excerpts_of_long_passages():
    """Any verbatim excerpt of 512 + 127 - 51 characters is found, wherever it starts."""
    rng = random.Random(5)
    passage = fold("".join(rng.choices("abcdefgh ", k=3000)))
    index = D.Index(["x"], [passage], D.Rules())
    for size in (588, 900):
        for at in (*range(0, len(passage) - size, 37), 60, len(passage) - size):
            assert index.leaks(passage[at : at + size]).keys() == {"x"}, at


def test_hashes_tell_qgrams_apart():
    rng = np.random.default_rng(0)
    codes = rng.integers(97, 100, 5000).astype(np.uint32)
    for q in (1, 5, 8, 13):
        own = D.hashes(codes, q)
        grams = [tuple(codes[i : i + q]) for i in range(len(codes) - q + 1)]
        assert len({(g, int(h)) for g, h in zip(grams, own, strict=True)}) == len(set(grams)) == len(set(own.tolist()))


def test_odd_rows(spark):
    text = "a passage that is long enough to be found by its character q-grams"
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, f"so: {text.upper()}!", 1), (3, f"so: {text.upper()}!", 1), (None, text, 2),
         (4, "word " * 60_000 + text, 0), (5, "clean", 0)],
        "doc_id long, text string, item_id long",
    )
    items = [(7, text), (7, "another text of the same item, never seen"), (8, None), (9, ""), (10, "word"), (None, text), (11, text)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = {(d, i) for d in (3, None, 4) for i in (7, 11)}
    for rules in (D.Rules(), D.Rules(block_chars=40)):
        got = D.leaks(docs, benchmark, rules).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == 8
        assert all(r.edits == 0 for r in got)
    assert (got[0].start_char, got[0].end_char) == (4, 4 + len(text)) if got[0].doc_id == 3 else True
    assert D.leaks(docs.limit(0), benchmark).count() == 0
    assert D.leaks(docs, benchmark.limit(0)).count() == 0
