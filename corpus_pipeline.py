"""Corpus pipeline over ``documents``: language, recurring lines, near copies, benchmark passages,
tokens. Each stage works on all that the one before it kept; between stages the documents are
written as Parquet to the shared intermediate folder and read again.

Stages and what they decide:

1. ``language_id``: documents without a letter, or whose best language has a mean probability
   below ``language_id.MIN_SCORE``, go.
2. ``line_dedup``: recurring lines go from all documents but the first; documents of which
   nothing remains are dropped. ``text`` and ``n_chars`` hold what remains.
3. ``near_dedup``: of each group of near copies the document with the smallest id stays.
4. ``decontaminate``: documents with a passage of a benchmark item go.
5. ``byte_bpe``: token ids of each document, their digest and the digest of the decoded bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.llm import bpe, common, decontaminate, language_id, line_dedup, near_dedup
from ontime_spark.session import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an accepted language; trained on their own labels."""
    return language_id.accepted(docs, language_id.fit(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; long ones, too, count from ``MIN_DOCS`` documents only: of
    near copies the next stage needs the whole text."""
    return line_dedup.cleaned_documents(docs, long_docs=line_dedup.MIN_DOCS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dedup.representatives(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean_documents(docs, common.read(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256."""
    done, r = bpe.round_trip(docs.select("doc_id", "text"), keep_ids=True)
    return done.select("doc_id", *[F.col(r)[c].alias(c)
                                   for c in ("n_tokens", "ids", "ids_sha256", "decoded_sha256")])


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("byte_bpe", token_stage),
]

#: A trained network, iterated grouping and tokenisation are not SQL; tests compare each stage
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what the last one returns."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
