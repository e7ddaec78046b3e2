"""From raw documents to packed training sequences: five stages, each one operator.

``STAGES`` holds them in order as (name, function). A function takes (spark, docs, folder of the tables);
all but the last return the columns of documents. The languages are learned from the documents
themselves, the benchmark is a table of the folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import decontaminate, language, packing, secret_scan, simhash_dedup
from tradewind.llm.names import quoted
from tradewind.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents have; others and letterless ones go.

    A label counts: documents without one have to be as close to a language as its own texts are.
    """
    model = language.train(docs)
    hidden = docs.select(
        F.struct(*quoted(docs.columns)).alias("doc"), F.col("text").alias("text")
    )
    # Stored once: the floors come from the scores of all labelled documents, the filter reads them again.
    found = materialize(language.identify(hidden, model).drop("text"), "identified")
    floors = language.floors(found, model, "doc.lang", "doc.text")
    labelled = F.col("doc.lang").isNotNull()
    return language.accepted(found, "doc.text", floors=floors, labelled=labelled).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return simhash_dedup.one_per_group(docs, simhash_dedup.near_duplicates(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, and ``n_chars`` follows; every document stays."""
    model = secret_scan.train(secret_scan.labelled_samples(docs, max_docs=None))
    hidden = docs.select(
        F.struct(*quoted(docs.columns)).alias("doc"), F.col("text").alias("text")
    )
    found = secret_scan.scan(hidden, model)
    masked = secret_scan.redacted(F.col("text"), F.col("spans"))
    rows = found.select("doc", masked.alias("masked"), (F.size("spans") > 0).alias("changed"))
    n_chars = F.when(F.col("changed"), F.length("masked")).otherwise(F.col("doc.n_chars"))
    made = {"text": F.col("masked"), "n_chars": n_chars.cast(docs.schema["n_chars"].dataType)}
    return rows.select(*(made.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, with the ids, and their place in sequences of 1024 ids.

    ``packing.assemble`` makes the sequences of them.
    """
    return packing.pack(packing.tokenize(docs).withColumn("ids_crc32", F.crc32("ids")))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Letter vectors, XXH64, alignments and tokenizers have no SQL form; tests hold the rows against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result a table that the next stage reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
