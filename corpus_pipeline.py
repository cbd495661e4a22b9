"""Documents to token ids: the stages of a training corpus, one after the other.

Each stage takes what its predecessor kept. Documents without a language, copies and
documents that hold benchmark passages go; secrets are masked; the last stage gives the ids.
"""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclens.llm import byte_pairs, decontamination, languages, near_duplicates, secrets
from topiclens.llm.common import shared_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, which are in a language; predictions reject none of them."""
    return languages.in_known_languages(docs, languages.fit(docs))


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least id, of each group of near copies."""
    return near_duplicates.without_duplicates(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets.redacted(docs).withColumn(
        "n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))
    )


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and of what they decode to."""
    return byte_pairs.encoded(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        digests=True,
    )


STAGES = [
    ("language", known_language),
    ("near_duplicates", unique_documents),
    ("decontamination", clean_of_benchmarks),
    ("secrets", masked_secrets),
    ("byte_pairs", token_ids),
]
#: Language identification is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table; what each keeps is written to the shared folder."""
    folder = f"{shared_folder(spark)}/corpus-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
