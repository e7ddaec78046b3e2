"""The operators as queries over whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    decontaminate,
    fingerprints,
    hard_negatives,
    html_extract,
    jaccard_join,
    language,
    merkle,
    packing,
    secret_scan,
    sharding,
    simhash_dedup,
    token_counts,
    url_filter,
)
from tradewind.llm.statements import STATEMENTS
from tradewind.session import materialize

#: Action, host, path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the benchmark items they hold, the edits and the place."""
    return decontaminate.leaks(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def fingerprint_digest(found: DataFrame, *more: str) -> DataFrame:
    digits = fingerprints.hex_digits
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digits(F.col("print")).alias("fingerprint"),
        digits(F.col("edited_print")).alias("edited_fingerprint"),
        fingerprints.likeness("print", "edited_print").alias("near_edited"),
        fingerprints.likeness("print", "next_print").alias("near_next"),
        *more,
    )


def op2_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of texts and edited texts; ``n_near`` for ids divisible by 100 is the number of
    distinct fingerprints of the table within 3 bits, the own one included."""
    docs = _table(spark, folder, "documents")
    found = materialize(fingerprints.with_edits(docs), "fingerprints")
    asked = found.where("doc_id % 100 = 0")
    near = fingerprints.within_radius(asked, found, "print", 3).groupBy("query")
    near = near.agg(F.count("*").alias("n_near")).withColumnRenamed("query", "print")
    # By fingerprint, since rows with one id may have several texts; other rows need no join.
    counted = asked.join(materialize(near, "near"), "print", "left")
    rest = found.where("doc_id % 100 <> 0 or doc_id is null")
    rest = rest.withColumn("n_near", F.lit(None).cast("long"))
    return fingerprint_digest(counted.unionByName(rest), "n_near")


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = language.held_out(docs["doc_id"])
    model = language.train(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", language.held_out(found["doc_id"]).alias("held_out"), "lang_pred", "score"
    )


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    n_chars = F.length(F.coalesce("text", F.lit(""))).cast("long")
    return token_counts.token_counts(docs.withColumn("n_chars", n_chars)).drop("text")


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    found = secret_scan.scan(docs, model)
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind))
    return found.select(
        "doc_id",
        *(of_kind(kind).cast("long").alias(f"n_{kind}") for kind, *_ in secret_scan.BASE),
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_digest(_table(spark, folder, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids and their place."""
    pieces = packing.tokenize(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces)


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    found = url_filter.judge(
        pages.select("page_id", "url"),
        url_filter.rules_table(spark, URL_RULES),
        url_filter.html_edges(pages),
    )
    return found.select("page_id", "host", "path", "rule", "verdict")


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_extract.extract(pages).drop("html")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.interleave(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_table(spark, folder, "documents"))
    return found.withColumn("fingerprint", simhash_dedup.hex_digits(found["fingerprint"]))


def op11_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of five-word shingles have a similarity of 0.8 or more."""
    return jaccard_join.near_duplicates(_table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of the vectors whose id is divisible by 100, against all others."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Digests, proofs, and whether a row that may have been tampered with still gives the root."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(tampered, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))
    found = [text if c == "text" else F.col(c) for c in columns]
    rows = merkle.manifest(_table(spark, folder, "documents"), columns, "lang", "doc_id", found)
    rows = rows.withColumn("folded_root", merkle.folded(F.col("found_leaf"), F.col("path")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def llm_queries() -> dict[str, Query]:
    return {
        "op1_benchmark_decontamination": op1_benchmark_decontamination,
        "op2_document_fingerprints": op2_document_fingerprints,
        "op3_language_id": op3_language_id,
        "op4_token_counts": op4_token_counts,
        "op5_secret_scan": op5_secret_scan,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_url_filter": op7_url_filter,
        "op8_html_extraction": op8_html_extraction,
        "op9_sharding": op9_sharding,
        "op10_simhash_near_dedup": op10_simhash_near_dedup,
        "op11_ngram_jaccard": op11_ngram_jaccard,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def llm_sql() -> dict[str, str]:
    return dict(STATEMENTS)
