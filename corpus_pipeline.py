"""Documents to training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and its result is written as Parquet in the shared
folder and read again as the next one's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from cadence.llm import nbsvm, ngram_join, packing, toxicity
from cadence.llm.common import id_remainder, table
from cadence.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar scores below 0.5."""
    sample = nbsvm.labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", id_remainder("doc_id", 5) != 0, toxicity.SAMPLE)
    return toxicity.keep_clean(docs, toxicity.train(sample), 0.5)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least 0.7."""
    sample = nbsvm.labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", id_remainder("doc_id", 4) != 2, nbsvm.SAMPLE)
    return nbsvm.keep_good(docs, nbsvm.train(sample), 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group that shares 3/4 of its 5-word shingles, link by link."""
    return ngram_join.one_of_each_group(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, in pieces placed in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("quality_classifier", drop_low_quality), ("ngram_jaccard_join", drop_near_duplicates),
          ("best_fit_packing", pack)]

#: The learnt scores can't be written in SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
