"""Named queries of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclens.llm import (
    byte_pairs,
    decontamination,
    languages,
    main_text,
    near_duplicates,
    packing,
    phrases,
    quality,
    secrets,
    top_matches,
    toxicity,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_line_blocks(spark, folder):
    """Main texts of pages."""
    return main_text.extracted(table(spark, folder, "pages"))


@query
def op2_winnowing(spark, folder):
    """Benchmark passages in documents."""
    return decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query
def op3_credential_links(spark, folder):
    """Secrets in documents."""
    found = secrets.credentials(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op4_string_kernel(spark, folder):
    """Languages of documents."""
    return languages.identify_held_out(table(spark, folder, "documents"))


@query
def op5_line_crf(spark, folder):
    """Quality of documents."""
    return quality.score_held_out(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_warc_derivatives(spark, folder):
    """Metadata and conversion records of pages."""
    return warc.derivatives(warc.responses(table(spark, folder, "pages")), "page_id")


@query
def op7_circulant_minhash(spark, folder):
    """Groups of near-duplicate documents."""
    return near_duplicates.duplicate_groups(table(spark, folder, "documents"))


@query
def op8_noisy_or(spark, folder):
    """Toxicity of documents."""
    return toxicity.score_held_out(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        "doc_id", "held_out", "score", "predicted", F.size("offending").cast("long").alias("n_offending")
    )


@query
def op9_segment_bounds(spark, folder):
    """The ten best matches of every hundredth embedding."""
    vectors = table(spark, folder, "embeddings")
    return top_matches.top_matches(vectors, F.col("vec_id") % 100 == 0)


@query
def op10_recursive_bpe(spark, folder):
    """Token ids of documents, and what they decode to."""
    import public_tokenizers

    return byte_pairs.encoded(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        digests=True,
    )


@query
def op11_householder(spark, folder):
    """Embeddings on their four leading components, whitened."""
    return whitening.whitened(table(spark, folder, "embeddings"))


@query
def op12_best_fit(spark, folder):
    """Documents packed into sequences of 2048 tokens."""
    import public_tokenizers

    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_stripes(spark, folder):
    """Phrases of each language."""
    return phrases.collocations(table(spark, folder, "documents"))
