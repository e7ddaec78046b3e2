"""The stages against brute force, on the tables and on odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import test_decontaminate
import test_packing
import test_secret_scan
import test_simhash_dedup
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tradewind.llm import decontaminate, language, packing, secret_scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def dedup_by_hand(docs):
    prints = [(d.doc_id, test_simhash_dedup.by_hand(d.text)) for d in docs]
    component = test_simhash_dedup.components(prints, 4)
    return [d for d in docs if component[d.doc_id] == d.doc_id]


def clean_by_hand(docs, benchmark):
    """Verbatim passages; the tables hold no edited ones that are near the budget."""
    passages = [test_decontaminate.fold(b.text) for b in benchmark]
    return [d for d in docs if not any(p in test_decontaminate.fold(d.text) for p in passages)]


def mask_by_hand(text, model):
    out, at = "", 0
    for start, _, end, _ in test_secret_scan.spans(text, model):
        if start > at or not at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def pieces_by_hand(docs):
    tokenizer = Tokenizer.from_file(packing.default_path())
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for piece, (at, n) in enumerate(packing.cuts(len(ids), 1024)):
            yield key, piece, at, n, zlib.crc32(ids[at : at + n].tobytes())


def test_run_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    kept = clean_by_hand(dedup_by_hand(docs), benchmark)
    assert len(kept) < len(dedup_by_hand(docs)) < len(docs)
    rows = spark.createDataFrame(kept, SCHEMA)
    model = secret_scan.train(secret_scan.labelled_samples(rows))
    masked = [(d.doc_id, mask_by_hand(d.text, model)) for d in kept]
    assert masked != [(d.doc_id, d.text) for d in kept]
    got = pipeline.run(spark, folder).collect()
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[c] for c in columns) for r in got) == Counter(pieces_by_hand(masked))
    used = test_packing.check_layout([(r.sequence_id, r.offset, r.length) for r in got], 1024)
    assert used == test_packing.best_fit([r.length for r in got], 1024)


@pytest.fixture(scope="module")
def odd(spark, folder):
    real = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    passage = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    rng = random.Random(0)
    fresh = "".join(rng.choices("abcdefgh ", k=700))
    rows = [
        (1001, None, None, None, None), (1002, "", "en", "a", 0), (1003, "12 :: 34", "en", "a", 8),
        (1004, f"x {passage} y", "en", "a", None), (1005, f'token = "{"Ab3x" * 6}" the', "en", "b", 9),
        (1006, fresh, None, "b", 700), (1007, fresh, None, "c", 700), (1007, fresh, None, "c", 700),
        (None, "the of and", "en", "a", 10), (None, "the of and", "en", "a", 10),
        (1008, "the " * 40_000, "en", "hot", 160_000), (1009, "中文字符" * 40, None, "a", 160),
    ]
    docs = real.union(spark.createDataFrame(rows, SCHEMA))
    # Names that the operators use themselves.
    return docs.withColumns({c: docs["doc_id"] for c in ("score", "lang_pred", "spans", "fingerprint", "doc", "_row", "masked")})


@pytest.mark.parametrize("name,stage", pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, folder, odd, name, stage):
    got = stage(spark, odd, folder)
    assert got.schema.simpleString() == odd.schema.simpleString()
    ids = Counter(r.doc_id for r in got.select("doc_id").collect())
    rows = Counter(r.doc_id for r in odd.select("doc_id").collect())
    gone = rows - ids
    assert not ids - rows
    if name == "language_id":
        # The random letters of 1006 and 1007 resemble no language either.
        assert set(gone) - {1006, 1007} == {1001, 1002, 1003, 1009}
    elif name == "near_dedup":
        assert gone[1007] == 2 and ids[1006] == 1 and ids[None] == 2 and gone[1002] == 1
    elif name == "decontamination":
        assert gone[1004] == 1 and not gone.keys() & {1001, 1002, 1005, None}
    else:
        assert not gone
        texts = {r.doc_id: (r.text, r.n_chars) for r in got.collect()}
        assert texts[1005] == ('[SECRET]" the', 13) and texts[1001] == (None, None)
        assert texts[1004][1] is None
    assert stage(spark, odd.limit(0), folder).count() == 0


def test_packing_stage(spark, folder, odd):
    got = pipeline.STAGES[-1][1](spark, odd, folder)
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(pieces_by_hand(docs))
    assert pipeline.STAGES[-1][1](spark, odd.limit(0), folder).count() == 0


def test_clean_documents_stay(spark, folder):
    """Ordinary documents of the table pass every filter."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    total = docs.count()
    assert pipeline.language_id(spark, docs, folder).count() == total
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    leaks = decontaminate.leaks(docs, benchmark).select("doc_id").distinct().count()
    assert pipeline.decontamination(spark, docs, folder).count() == total - leaks


def test_packed_sequences_can_be_built(spark, folder, odd):
    got = pipeline.STAGES[-1][1](spark, odd, folder)
    rows = got.collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.assemble(got).collect()}
    assert all(whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids) for r in rows)


@pytest.mark.parametrize("name", ["de", "en", "es", "fr"])
def test_documents_in_unlearned_languages_go(spark, name):
    """Without the labels of a language, long texts of it go, and unlabelled texts of the others stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) >= 400")
    hide = (docs["lang"] == name) | (docs["doc_id"] % 10 == 0)
    planted = docs.withColumns({"source": docs["lang"], "lang": packing.F.when(~hide, docs["lang"])})
    kept = pipeline.language_id(spark, planted, "").select("doc_id").collect()
    kept = {r.doc_id for r in kept}
    rows = planted.select("doc_id", "lang", "source").collect()
    foreign = [r.doc_id in kept for r in rows if r.source == name]
    own = [r.doc_id in kept for r in rows if r.source != name and r.lang is None]
    assert sum(foreign) <= 0.02 * len(foreign) and sum(own) >= 0.95 * len(own)


def test_floors_and_samples_come_from_all_documents(spark):
    """More documents than the 20,000 that a sample of floors or of labelled tokens once held."""
    near = " ".join(["the kitten sat on a mat and the dog ran to the house"] * 3)
    far = " ".join(["a bird flew over an old river while children sang here"] * 3)
    texts = packing.F.when(packing.F.col("doc_id") % 2 == 0, near).otherwise(far)
    docs = spark.range(30_000).select(
        packing.F.col("id").alias("doc_id"), packing.F.lit("en").alias("lang")
    ).withColumn("text", texts)
    model = language.train(docs)
    found = language.identify(docs, model)
    with pytest.MonkeyPatch.context() as patch:
        # How many scores a floor is made of.
        patch.setattr(language.F, "percentile_approx", lambda column, share: language.F.count(column))
        got = language.floors(found, model, share=1.0)
    assert max(got.values()) == 30_000
    tokens = secret_scan.labelled_samples(docs, max_docs=None)
    assert tokens.count() > 1.2 * secret_scan.labelled_samples(docs).count() > 0
