"""From documents to packed training sequences, in five stages.

Each stage calls one operator of ``tabula.llm`` on everything the stage before
kept; its output is written as Parquet in the shared scratch folder and read
again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import classifier_chain, golay_dedup, importance, packing, suffix_dedup
from tabula.llm.common import table
from tabula.session import drop_scratch, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the log-likelihood ratio keep."""
    return importance.keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    return classifier_chain.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, three bits."""
    return golay_dedup.drop_near_duplicates(docs, shingle=3, bits=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated 200-byte strings; ``n_chars`` follows the text."""
    left = suffix_dedup.remove_repeats(docs)
    if "n_chars" not in left.columns:
        return left
    return left.withColumn("n_chars", F.length("text").cast(left.schema["n_chars"].dataType))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    return packing.packed(docs, tokenizer, end=1)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("packing", packed_sequences),
]

#: Hashed features, fitted models and a tokenizer are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_scratch(spark, before)     # what was written after it does not need it
        before = path
    return docs
