"""Corpus pipeline: toxic documents go, copies go, the rest is mixed by source and tokenised.

Each stage gets the Parquet rows that the one before it wrote. The stages:
  toxicity   drops documents that the counterfactually regularised classifier scores 0.3 or more
  exact      keeps the first of equal texts (white space aside)
  near       keeps one document of each SimHash class (3-word shingles, at most 2 differing bits)
  mix        apportions blocks of words to sources by weights 3, 1, 2, in all 150 % of the words
  tokenise   encodes with SentencePiece and decodes again as a check
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabsmith.llm.common import read, scratch_dir
from tabsmith.llm.exact_dedup import keep_first
from tabsmith.llm.langid import held_out
from tabsmith.llm.mixing import mixed
from tabsmith.llm.pieces import encode_documents
from tabsmith.llm.simhash import keep_one_per_class
from tabsmith.llm.toxicity import fit, keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned, as in op10, from the labels outside the held-out rows; every document is scored on its text alone."""
    model = fit(docs, read(spark, sf_dir, "labels").filter(~held_out("doc_id", 4, 2)))
    return keep_clean(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts equal but for white space keep the row with the smallest id (null ids last; null texts are empty ones)."""
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per near-duplicate class stays, the smallest id (null ids last); texts without words are one class."""
    return keep_one_per_class(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes, with the words taken; null sources are one, null and empty texts go."""
    return mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per mixed text: doc_id, lang, source, ids, n_tokens, round_trip."""
    return encode_documents(docs, keep=["doc_id", "lang", "source"])


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("SimHash near-dedup", near), ("mixing", mix),
          ("SentencePiece", tokenise)]

ORACLE_SQL = None  # fingerprints, classifiers and tokenizers are not expressible; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written below the shared checkpoint folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
