from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradewind.llm import packing as K


def check_layout(rows, capacity):
    """Gapless sequences within the capacity; rows: (sequence, offset, length)."""
    by = defaultdict(list)
    for sequence, offset, length in rows:
        by[sequence].append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def best_fit(lengths, capacity):
    """Sequences used by best fit over single pieces in descending order."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= length
        else:
            room.append(capacity - length)
    return len(room)


def test_query(spark, folder):
    from tokenizers import Tokenizer

    from tradewind.llm.queries import op6_best_fit_packing

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op6_best_fit_packing(spark, folder).collect()
    tokenizer = Tokenizer.from_file(K.default_path())
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by.keys() == docs.keys()
    lengths = []
    for key, text in docs.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        parts = sorted(by[key], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start for r in parts] == [0, *np.cumsum([r.length for r in parts])[:-1]]
        assert sum(r.length for r in parts) == len(ids)
        assert all(r.length == 1024 for r in parts[1:]) and len(parts) == -(-len(ids) // 1024)
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        lengths += [r.length for r in parts]
    used = check_layout([(r.sequence_id, r.offset, r.length) for r in got], 1024)
    assert used == best_fit(lengths, 1024) and used <= 1.02 * sum(lengths) / 1024 + 1


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_best_fit_of_single_pieces(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 50])
    lengths = [min(capacity, 1 + int(rng.expovariate(4 / capacity))) for _ in range(rng.randrange(0, 400))]
    counts = Counter(lengths)
    rows = []
    for s in K.plan(counts, capacity):
        rows += [
            (s.sequence + (r - s.low) // s.each, s.offset + (r - s.low) % s.each * s.length, s.length, r)
            for r in range(s.low, s.high)
        ]
    assert Counter((length, r) for *_, length, r in rows) == Counter((n, r) for n, c in counts.items() for r in range(c))
    assert check_layout([r[:3] for r in rows], capacity) == best_fit(lengths, capacity)


def test_plan_size_follows_the_capacity_only():
    rng = random.Random(4)
    counts = {n: rng.randrange(1, 50) for n in range(1, 1025)}
    small = len(K.plan(counts, 1024))
    large = len(K.plan({n: c * 1_000_003 for n, c in counts.items()}, 1024))
    assert max(small, large) < 40_000


def test_encoder_equals_the_library():
    encode = K.encoder(K.default_path())
    rng = random.Random(0)
    bits = [" ", "  ", "\n", "\r\n", "'s", "I'LL", "é", "漢字", "😀", "12", "²", " ", "\x85", "ab", "<|endoftext|>", "﻿", "­"]
    texts = ["", "<|endoftext|>", "a" * 5000, " " * 3000]
    texts += ["".join(rng.choices(bits, k=30)) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(40)) for _ in range(300)]
    for text in texts:
        assert encode(text) == encode.reference.encode(text, add_special_tokens=False).ids


def test_very_long_white_space(spark):
    encode = K.encoder(K.default_path())
    for text in (" " * 2_000_000, "a" + "\n " * 1_000_000 + "word"):
        assert encode(text) == encode.reference.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame([(1, " " * 2_000_000)], "doc_id long, text string")
    assert K.tokenize(docs).agg({"length": "sum"}).first()[0] == len(encode(" " * 2_000_000)) + 1


def test_many_long_runs_are_searched_in_one_pass():
    import time

    encode = K.Encoder(K.default_path())
    text = ("a" + " " * (K.LONG_SPACE - 1)) * 30
    start = time.perf_counter()
    assert not K._LONG_SPACE.search(text) and K._LONG_SPACE.search(text + "b" + " " * K.LONG_SPACE)
    assert time.perf_counter() - start < 2
    assert encode(text) == encode.reference.encode(text, add_special_tokens=False).ids


def test_odd_rows(spark):
    long = "the " * 9000
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "x"), (5, "the " * 1023), (6, "the " * 1024)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("sequence_id", "piece", "_rank", "_length", "_row"):
        docs = docs.withColumn(name, docs["text"])
    packed = K.pack(K.tokenize(docs).repartition(5))
    got = packed.collect()
    lengths = Counter((r.doc_id, r.piece, r.length) for r in got)
    encode = K.encoder(K.default_path())
    want = [(i, n, size) for i, t in rows for n, (_, size) in enumerate(K.cuts(len(encode(t or "")) + 1, 1024))]
    assert lengths == Counter(want) and lengths[1, 0, 1] == 1
    used = check_layout([(r.sequence_id, r.offset, r.length) for r in got], 1024)
    whole = K.assemble(packed).collect()
    assert len(whole) == used and sum(r.n_ids for r in whole) == sum(r.length for r in got)
    by = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in whole}
    for r in got:
        assert by[r.sequence_id][r.offset : r.offset + r.length].tobytes() == bytes(r.ids)
    assert K.pack(K.tokenize(docs.limit(0))).count() == 0


def test_clashing_names(spark):
    rows = [(f"p{i}", 1 + i % 5, i) for i in range(40)]
    pieces = spark.createDataFrame(rows, "name string, length int, n int")
    extra = {c: pieces["n"] for c in ("_row", "_length", "_task", "_at", "_rank", "_n", "offset", "a.b")}
    got = K.pack(pieces.withColumns(extra), 7).collect()
    assert {(r["name"], r["length"], r["_length"], r["_task"], r["a.b"]) for r in got} == {(a, b, c, c, c) for a, b, c in rows}
    assert check_layout([(r.sequence_id, r["offset"], r["length"]) for r in got], 7) == best_fit([r[1] for r in rows], 7)


def test_first_piece_takes_the_rest():
    assert K.cuts(1, 4) == [(0, 1)] and K.cuts(4, 4) == [(0, 4)]
    assert K.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)] and K.cuts(8, 4) == [(0, 4), (4, 4)]
