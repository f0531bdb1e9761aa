"""A training corpus from raw documents, stage by stage.

Each stage takes ``documents`` as its predecessor left them and returns their columns; the last one
returns pieces of packed sequences.  A stage that filters keeps every document it has nothing
against.  Rows with a NULL ``doc_id`` are kept where only their text is judged.

Not expressible in SQL as a whole (compression, hashing, a tokenizer), so there is no twin; the tests
hold ``run`` against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm import decontaminate, language_id, near_duplicates, packing, private_data
from statflow.llm.common import small_batches, stored, table

TOKENIZER = "byte_bpe_50k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told, NULL texts and those without a letter among them.

    Learns from the labelled documents that are not held out."""
    small_batches(spark)
    model = language_id.learn(docs.where(~language_id.held_out()))
    return language_id.predict(docs, model).where("not rejected").select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class, the one with the smallest id."""
    small_batches(spark)
    kept = near_duplicates.classes(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    nameless = docs.where("doc_id is null")
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).unionByName(nameless)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold passages of ``benchmark``."""
    small_batches(spark)
    return decontaminate.scan(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select(docs.columns)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts marks in place of personal data; ``n_chars`` follows the text where it changes."""
    found = private_data.redact(private_data.annotate(docs))
    length = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs documents into sequences with their lexical neighbours."""
    small_batches(spark)
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("private_data", without_private_data),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back for the next stage."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
