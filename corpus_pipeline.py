"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and reread as the next one's docs.  All but the last return the columns of documents:

1. ``quality`` drops the documents that the rules reject;
2. ``near_duplicates`` keeps one document of each group (5-word shingles, similarity 0.8);
3. ``personal_data`` replaces every span by its kind in brackets;
4. ``mixing`` emits each document as often as the mix of sources takes it;
5. ``packing`` cuts documents into pieces and packs them into sequences.

Each stage works on all its predecessor kept, nulls, repeated rows and empty tables included.  ``n_chars`` follows
the text where a stage changes it.  SQL has no tokenizer and no packing, so ``ORACLE_SQL`` is None;
``tests/llm/test_pipeline.py`` holds each stage against plain Python on the smallest table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import minhash, mixing, packing, pii, quality
from mercato.llm.common import shared_folder, table


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
