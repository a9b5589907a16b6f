"""From raw documents to a mixed, tokenised corpus.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one
before it kept.  ``run`` writes each stage's result into the shared folder and
reads it again for the next, so a lost executor costs work of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trajex.llm import bpe, exact_dedup, mixing, quality, simhash
from trajex.llm.common import safe_names, stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep, with their own columns whatever the
    names."""
    safe, name, back = safe_names(docs)
    judged = quality.judge(safe, public_tokenizers.path("piece_bpe_32k.model"), name["text"], name["lang"])
    return judged.filter("kept").select(*back)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return simhash.deduplicate(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or the parts of them, that the mix takes, once per pass."""
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every mixed document."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       public_tokenizers.PATTERN)
    return coded.select("doc_id", "source", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("source mixing", source_mix),
    ("byte-level bpe", byte_bpe),
]

#: SQL cannot express the tokenisers and shingle hashes; tests/llm/test_pipeline
#: holds run() against plain Python on planted documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
