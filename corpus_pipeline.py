"""Corpus pipeline: toxic documents go, repeated passages go, near copies go, sources are mixed, texts are encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievelog.llm.bpe import bpe_encode
from sievelog.llm.common import Scratch, rows_of
from sievelog.llm.line_dedup import drop_repeated_blocks
from sievelog.llm.mixing import mixed_documents
from sievelog.llm.queries import tokenizer_file
from sievelog.llm.shingle_dedup import drop_near_copies
from sievelog.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the model is fitted on the labelled rows among ``docs``."""
    return reject_toxic(docs, rows_of(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document holds go, and documents that hold nothing else."""
    return drop_repeated_blocks(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash fingerprints of at most 2 differing bits link texts, as in
    operator 4, and so does a similarity of 0.8 or more of their five-word shingles, which fingerprints don't reach."""
    return drop_near_copies(docs, threshold=0.8, ngram=5, radius=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document drawn in two passes comes twice."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded text."""
    return bpe_encode(docs, tokenizer_file("byte_bpe_50k.json"), keep=("doc_id", "source"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash", simhash), ("mixing", mixing), ("encoding", encoding)]

#: Training, alignment, near-copy search, random mixing and BPE are beyond SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = rows_of(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
