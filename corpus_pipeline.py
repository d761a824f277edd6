"""The corpus pipeline: language ID, exact dedup, near dedup, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that the next one reads as ``docs``; all but the last return
the columns of ``docs``. ``run`` writes every stage to the shared scratch folder and reads it again.

Defined results: rows are judged each by its own text, so a doc_id may stand on several rows, and a repeated row is one
document for the two dedup stages. A null or empty text has no language and goes with the first stage. Other columns are
carried along whatever their names (those that start with ``__tb_`` are the operators' own). An empty table gives an
empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabularium.llm import exact_dedup, language, near_dedup, packing, secrets
from tabularium.llm.common import stash


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the languages learnt go: no letter in them, or no likelier in any language than by chance.

    A null lang becomes the predicted one.
    """
    return language.keep_identified(docs, public_tokenizers.path("piece_bpe_32k.model"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id stays."""
    return near_dedup.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no document goes."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in the training sequences."""
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Fingerprints, learnt languages and the packing are beyond SQL; tests/llm/test_pipeline.py holds ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
