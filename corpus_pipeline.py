"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows its predecessor kept and is written as Parquet before
the next one reads it.  All but the last return the columns of ``documents``:

1. language ID: a text without a letter, or far from every learned language, goes;
2. quality: a text scoring below 0.3 goes;
3. near-duplicates: the least id of each class stays (rows of one id stay together,
   rows without an id stay);
4. repeated passages: bytes that an earlier document holds are cut from the text,
   ``n_chars`` is counted again, emptied documents stay as rows;
5. packing: every piece of every document with its place in a training sequence.

Null texts go in the first stage; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import kernel, langid, neardup, packing, quality, suffixes

LANGUAGE_SCORE = 0.3
QUALITY_SCORE = 0.3
TOKENIZER = "byte_bpe_50k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kernel.prepared(spark)
    profiles = langid.learn(docs.where(~kernel.held_out(F.col("doc_id"), 4, 2)))
    return langid.accepted(docs, profiles, LANGUAGE_SCORE)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kernel.prepared(spark)
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model, QUALITY_SCORE)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kernel.prepared(spark)
    copies = neardup.classes(docs).where("NOT kept").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kernel.prepared(spark)
    left = suffixes.cleaned(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kernel.prepared(spark)
    parts = packing.cut_pieces(docs, public_tokenizers.path(TOKENIZER))
    return packing.pack(kernel.stored(parts, "pieces"))


STAGES = [
    ("language_id", language),
    ("quality", good),
    ("near_dedup", distinct),
    ("suffix_dedup", without_passages),
    ("packing", packed),
]
# The stages learn models, sample consistently and merge tokens: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = kernel.stored(docs, name)
    return docs
