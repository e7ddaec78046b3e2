from __future__ import annotations

import zlib
from collections import Counter

import pytest

from tradewind.llm import sharding as H

SCHEMA = "doc_id long, text string, source string"


def check(rows, got, shards=16):
    """Counts, slots, digests, and the mixture of every shard."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    by = Counter(r.shard for r in got)
    if len(rows) >= shards:
        assert set(by) == set(range(shards)) and max(by.values()) - min(by.values()) <= 1
    else:
        assert all(n == 1 for n in by.values())
    for shard, n in by.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    strata = Counter(s for *_, s in rows)
    seen = Counter((r.shard, r.source) for r in got)
    for shard in by:
        for stratum, n in strata.items():
            # The cuts fall where all strata together have their share, which their rounding moves.
            assert abs(seen[shard, stratum] - n * by[shard] / len(rows)) < 2 + len(strata) ** 0.5


def test_query(spark, folder):
    from tradewind.llm.queries import op9_sharding

    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = op9_sharding(spark, folder).collect()
    check(docs, got)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    # The same rows again, whatever the partitions.
    again = H.interleave(spark.read.parquet(f"{folder}/documents.parquet").repartition(5))
    assert {(r.doc_id, r.shard, r.slot) for r in again.collect()} == {(r.doc_id, r.shard, r.slot) for r in got}


@pytest.mark.parametrize("n,bits", [(5, 1), (333, 4), (3000, 9)])
def test_many_ranges(spark, n, bits, monkeypatch):
    monkeypatch.setattr(H, "RANGE_ROWS", max(1, n >> bits))
    rows = [(i, f"t{i}" * (i % 7), "hot" if i % 3 else f"s{i % 11}") for i in range(n)]
    got = H.interleave(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)


def test_order_is_shuffled_by_seed(spark):
    rows = [(i, "x", "a") for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    one = {r.doc_id: (r.shard, r.slot) for r in H.interleave(docs).collect()}
    two = {r.doc_id: (r.shard, r.slot) for r in H.interleave(docs, seed=7).collect()}
    assert one != two
    assert [one[i] for i in range(200)] != sorted(one.values())


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "é😀", "a"), (3, "é😀", "a"), (None, "z", "a"), (None, None, None)]
    rows += [(9, "same", "hot")] * 40 + [(10, "long " * 50_000, "a")]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.withColumns({c: docs["text"] for c in ("shard", "slot", "size", "_rank", "_hash")})
    got = H.interleave(docs).collect()
    check(rows, got)
    assert H.interleave(docs.limit(0)).count() == 0
    one = H.interleave(docs.limit(1)).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]


def test_files(spark, scratch):
    docs = spark.createDataFrame([(i, f"t{i}", f"s{i % 3}") for i in range(100)], SCHEMA)
    H.write_shards(H.interleave(docs), f"{scratch}/shards")
    back = spark.read.parquet(f"{scratch}/shards")
    assert back.groupBy("shard").count().count() == 16 and back.count() == 100
