"""Training-corpus pipeline: quality rules, near-duplicates, benchmark passages, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm import bpe, decontaminate, neardup, pii, quality
from vitalis.llm.queries import table
from vitalis.llm.scratch import written

RANKS = "byte_bpe_multi_50k.tiktoken"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by four fifths or more of their five-word shingles, the one with the least id stays."""
    return neardup.keep_one(docs, shingle=5, similarity=(80, 100))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away are replaced in the text; n_chars follows."""
    masked = pii.sanitise(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (binary, little-endian unsigned 32-bit), with digests of the ids and of what they decode to."""
    vocabulary = bpe.broadcast(spark, public_tokenizers.path(RANKS))
    coded = bpe.with_ids(docs.select("doc_id", "lang", "source", "text"), vocabulary, decoded="decoded").drop("text")
    return coded.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one),
    ("decontaminate", drop_benchmark),
    ("personal_data", mask_personal),
    ("encode", encode),
]

#: Cutoffs by exact binomial tests, links over signatures, tokens by merges: no SQL.  tests/llm compare every stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each result but the last written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
