"""The corpus pipeline: documents through five stages of the corpus operators.

Every stage takes what its predecessor kept, written as Parquet and read again.  All stages
but the last return the columns of documents:

1. quality: documents that the weak-label classifier rejects go;
2. language: documents without a determined language go;
3. near duplicates: one document of each group stays, the one with the smallest id;
4. repeated strings: bytes covered by a repeated string of 200 bytes go from the texts of the
   documents that are left; a document without any text left goes;
5. packing: the pieces of all documents and their places in sequences of 1,024 tokens.

Texts are null, empty or long as they come; null ids are kept; an empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import language, packing, quality, setsketch, suffix_dedup
from tablewright.llm.common import table
from tablewright.shared import written

LEAST_QUALITY = 0.5
LEAST_LANGUAGE_SCORE = 0.35


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.kept(docs, quality.train(docs), LEAST_QUALITY)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are of a determined language; ``lang`` stays as it is."""
    return language.kept(docs, language.train(docs), LEAST_LANGUAGE_SCORE)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (five words, similarity 0.8)."""
    return setsketch.first_of_each(docs, setsketch.Similar(words=5, percent=80))


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeated strings cover."""
    return suffix_dedup.stripped(docs, window=200)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in the training sequences."""
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024,
        ranks_file=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("repeated_strings", without_repeated_strings),
    ("packing", packed),
]

#: The classifiers and the tokenizer cannot be expressed in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
