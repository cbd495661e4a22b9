"""Bag-of-words features in long form: one row per article and term.

Counts are made inside each article's own row, so no token is shuffled; what
crosses the network is one partly aggregated row per term and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclens.functions.stemming import with_stem
from topiclens.functions.text import singulars

# Vocabulary limits of the topic model.
MIN_DF = 5
MIN_TF = 5
VOCAB_SIZE = 2000


#: Tokens that are looked at together inside a task.
TOGETHER = 1 << 18


def slices(sizes: np.ndarray, together: int) -> Iterator[tuple[int, int]]:
    """Where runs of rows start and stop whose sizes add up to about `together`."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + together, "right")))
        yield start, stop
        start = stop


def pieces(batch: pa.RecordBatch, together: int = TOGETHER) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows `post_id, tokens` in pieces of about `together` tokens, with each row's number of tokens."""
    sizes = pc.list_value_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for start, stop in slices(sizes, together):
        yield batch.slice(start, stop - start), sizes[start:stop]


def counted(owner: np.ndarray, number: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of owner and number (below `size`), in order, and how often each occurs."""
    pair, n = np.unique(owner * max(size, 1) + number, return_counts=True)
    return *np.divmod(pair, max(size, 1)), n


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, sizes in pieces(batch):
            coded = rows.column(1).flatten().dictionary_encode()
            owner = np.repeat(np.arange(len(sizes)), sizes)[coded.is_valid().to_numpy(zero_copy_only=False)]
            number = coded.indices.drop_null().to_numpy().astype(np.int64)
            owner, number, n = counted(owner, number, len(coded.dictionary))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(owner)), coded.dictionary.take(pa.array(number)), pa.array(n)],
                names=["post_id", "term", "tf"],
            )


def term_counts(articles: DataFrame) -> DataFrame:
    """`post_id, term, tf` from `post_id, tokens` or from bags; `post_id` is unique in the input.

    An article's tokens are counted by their numbers, batch by batch, where they are.
    """
    from topiclens.operators import bags  # which counts by the functions of this module

    if bags.is_bags(articles):
        return bags.counts(articles)
    kind = articles.schema["post_id"].dataType.simpleString()
    return articles.select("post_id", "tokens").mapInArrow(
        _counts, f"post_id {kind}, term string, tf bigint"
    )


def keep_frequent(counts: DataFrame, min_tf: float) -> DataFrame:
    """Drop terms too rare in their article: below a count, or a fraction if `min_tf` < 1."""
    return counts.withColumn("_kept", _is_frequent(min_tf)).filter("_kept").drop("_kept")


def _is_frequent(min_tf: float) -> Column:
    if min_tf >= 1:
        return F.col("tf") >= min_tf
    # An article's terms are one group.
    return F.col("tf") >= min_tf * F.sum("tf").over(Window.partitionBy("post_id"))


def vocabulary(
    counts: DataFrame,
    min_df: int = MIN_DF,
    vocab_size: int = VOCAB_SIZE,
    min_tf: float = MIN_TF,
) -> DataFrame:
    """`term_id, term, corpus_count, doc_freq, kept_docs`: the commonest terms.

    `doc_freq` counts every article with the term; `kept_docs` only those in which it
    is frequent by `min_tf`. Ties in `corpus_count` are ordered by term.
    """
    return commonest(totals(counts, min_tf), min_df, vocab_size)


def totals(counts: DataFrame, min_tf: float) -> DataFrame:
    """`term, corpus_count, doc_freq, kept_docs` of every term."""
    return (
        counts.withColumn("_kept", _is_frequent(min_tf))
        .groupBy("term")
        .agg(
            F.sum("tf").alias("corpus_count"),
            F.count(F.lit(1)).alias("doc_freq"),
            F.count_if("_kept").alias("kept_docs"),
        )
    )


def commonest(totals: DataFrame, min_df: float, vocab_size: int) -> DataFrame:
    """The `vocab_size` commonest of the terms in `min_df` articles or more, numbered."""
    terms = (
        totals.filter(F.col("doc_freq") >= min_df)
        .orderBy(F.desc("corpus_count"), "term")
        .limit(vocab_size)
    )
    # One partition, but at most `vocab_size` rows.
    order = Window.orderBy(F.desc("corpus_count"), "term")
    return terms.select((F.row_number().over(order) - 1).alias("term_id"), "*")


def tfidf(
    counts: DataFrame,
    vocab: DataFrame,
    articles: DataFrame,
    min_tf: float = MIN_TF,
) -> DataFrame:
    """`post_id, term, tf, tfidf` with idf = ln((N + 1) / (kept_docs + 1)).

    N counts all articles, also those without a term left. The planner broadcasts the
    vocabulary if it is small.
    """
    n = articles.agg(F.count(F.lit(1)).alias("n")).scalar()
    weights = vocab.select("term", F.log((n + 1) / (F.col("kept_docs") + 1)).alias("idf"))
    return (
        keep_frequent(counts, min_tf)
        .join(weights, "term")
        .select("post_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    )


def distinct_terms(counts: DataFrame) -> DataFrame:
    return counts.select("term").distinct()


def stem_terms(counts: DataFrame) -> DataFrame:
    """`term, stem` for each distinct term; join it back on `term`."""
    return with_stem(distinct_terms(counts))


def map_terms(counts: DataFrame, table: DataFrame, target: str) -> DataFrame:
    """Replace terms by `target` of a (term, target) table and add up their counts.

    Terms the table does not list stay. The planner broadcasts the table if it is
    small; else the join is shuffled and AQE splits the commonest terms.
    """
    return (
        counts.join(table.select("term", target), "term", "left")
        .select("post_id", F.coalesce(target, "term").alias("term"), "tf")
        .groupBy("post_id", "term")
        .agg(F.sum("tf").alias("tf"))
    )


def lemmatize(counts: DataFrame, lemma_table: DataFrame) -> DataFrame:
    """Terms to their dictionary form, from a table (term, lemma).

    Only counts that may meet, of terms that are replaced and of those that replace them, are
    added up by article; all others stay where they are. As few terms are replaced, that is
    far less than all counts. Both tables are read more than once.
    """
    listed = lemma_table.select("term", "lemma")
    targets = listed.select(F.col("lemma").alias("term"), "lemma").distinct()
    targets = targets.join(listed.select("term"), "term", "left_anti")
    joined = counts.join(listed.unionByName(targets), "term", "left")
    meeting = (
        joined.filter("lemma IS NOT NULL")
        .groupBy("post_id", F.col("lemma").alias("term"))
        .agg(F.sum("tf").alias("tf"))
    )
    alone = joined.filter("lemma IS NULL").select("post_id", "term", "tf")
    return alone.unionByName(meeting)


def stem(counts: DataFrame) -> DataFrame:
    """Terms to their stems. Each distinct term is stemmed once, then joined back."""
    return map_terms(counts, stem_terms(counts), "stem")


def bags(counts: DataFrame, articles: DataFrame) -> DataFrame:
    """`post_id, tokens` from counts, each term as often as it counts; order is lost.

    Every article stays, with no tokens if it has no counts. A group is one article.
    """
    repeated = F.flatten(F.collect_list(F.expr("array_repeat(term, CAST(tf AS INT))")))
    tokens = counts.groupBy("post_id").agg(repeated.alias("tokens"))
    none = F.array().cast("array<string>")
    return (
        articles.select("post_id")
        .join(tokens, "post_id", "left")
        .select("post_id", F.coalesce("tokens", none).alias("tokens"))
    )


def term_totals(counts: DataFrame) -> DataFrame:
    """`term, corpus_count, doc_freq` over all articles."""
    return counts.groupBy("term").agg(
        F.sum("tf").alias("corpus_count"), F.count(F.lit(1)).alias("doc_freq")
    )


def plural_lemmas(counts: DataFrame) -> DataFrame:
    """`term, lemma` for terms whose regular singular is itself a term of the corpus.

    Of two singulars that are terms, the likelier counts.
    """
    return plurals_among(distinct_terms(counts))


def plurals_among(known: DataFrame) -> DataFrame:
    """`plural_lemmas` of distinct terms, which are read twice."""
    forms = known.select("term", F.posexplode(singulars(F.col("term"))).alias("place", "lemma"))
    found = forms.join(known.withColumnRenamed("term", "lemma"), "lemma", "left_semi")
    first = F.min(F.struct("place", "lemma"))
    return found.groupBy("term").agg(first.alias("first")).select("term", "first.lemma")
