"""A training-data pipeline over ``documents``: five stages, each one operator of ``hiremart.llm``.

Every stage works on all that its predecessor kept, over whole texts.  The first
four return the columns of ``documents``; the last returns doc_id, ids, n_tokens and digests.

1. toxicity: texts that score 0.7 or more go.
2. ngram_jaccard: of each group of texts linked at a Jaccard similarity of
   75 % of their five-word shingles, the one with the least doc_id stays.
3. suffix_dedup: strings of 100 bytes that also start earlier are cut from the
   texts; n_chars follows where there is one; a document of which nothing is left goes.
4. decontaminate: documents go that have a benchmark window and at least a
   twentieth of their words in such windows.
5. bpe: byte-level BPE ids of what is left, decoded again for the digest.
"""

from __future__ import annotations

import public_tokenizers as P
from pyspark.sql import DataFrame, SparkSession

from hiremart.llm import bpe, decontaminate, ngram_join, suffix_dedup, toxicity
from hiremart.llm.common import discard, passing_copies, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def ngram_jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_component(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, size="n_chars" if "n_chars" in docs.columns else None)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", ngram_jaccard_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("bpe", bpe_stage),
]

#: No SQL: scoring, the suffix transform and BPE are not expressible; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again.

    When a stage is written, the copies that it made on the way, and the stage before it, are deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with passing_copies() as kept:
            done = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            kept.append(done)
        discard(docs)
        docs = done
    return docs
