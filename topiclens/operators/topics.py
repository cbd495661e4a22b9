"""Latent topics: fitting, assigning, describing.

Topics are fitted on `post_id, tokens`, or on their `bags`, by `clusters`, whose result does not depend on how the
articles are dealt out; LDA is Spark ML's, on vectors made from bags. The long-form operators below do
the same steps as joins and aggregates, with an order for ties that ML does not promise.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclens import schemas, storage
from topiclens.functions.vectors import squared_distance
from topiclens.operators import bags, clusters, neighbours
from topiclens.operators.clusters import TopicModel
from topiclens.operators.terms import MIN_DF, MIN_TF, VOCAB_SIZE

# Settings of the topic model.
K = 25
MAX_ITER = 50
SEED = 123
TOP_TERMS = 10
COST_UNIT = 1_000_000
LDA_K = 5
LDA_MAX_ITER = 20


def feature_stages(
    min_df: float = MIN_DF, min_tf: float = MIN_TF, vocab_size: int = VOCAB_SIZE
) -> list:
    counts = CountVectorizer(
        inputCol="tokens", outputCol="counts", minDF=min_df, minTF=min_tf, vocabSize=vocab_size
    )
    return [counts, IDF(inputCol="counts", outputCol="tfidf")]


@contextmanager
def _kept(df: DataFrame):
    """Keep a frame that is read several times; one the caller keeps already stays kept."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


#: Articles in a part that LDA adds up by itself: the least, and the most beyond PARTS parts.
ARTICLES_IN_PART, MOST_IN_PART, PARTS = 1000, 16_000, 64


def dealt(found: DataFrame, articles: int | None = None) -> DataFrame:
    """The rows, one for each of the articles, in parts of ARTICLES_IN_PART or more, by id and in its order.

    LDA adds up in the order of the parts; they come from the number of articles, so it gives
    the same on every cluster. Each part sends something to the driver in each round, so parts
    grow before their number does: there are PARTS of them up to MOST_IN_PART articles in each.
    """
    articles = found.count() if articles is None else articles
    parts = max(1, min(-(-articles // ARTICLES_IN_PART), max(PARTS, -(-articles // MOST_IN_PART))))
    return found.repartition(parts, "post_id").sortWithinPartitions("post_id")


def tfidf_vectors(found: DataFrame, vocabulary: list[str], idf: list[float], min_tf: float) -> DataFrame:
    """`post_id, tfidf` of bags, a sparse ML vector for each article, as of `feature_stages`."""
    shared = found.sparkSession.sparkContext.broadcast((vocabulary, idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, idf = shared.value
        words, idf = pa.array(vocabulary, pa.string()), np.array(idf, np.float64)
        for p in bags.opened(batches):
            owner, term, n = clusters.entries(p, words, min_tf)
            ends = pa.array(np.searchsorted(owner, np.arange(len(p.ids) + 1)).astype(np.int32))
            fields = {
                "type": pa.array(np.zeros(len(p.ids), np.int8)),  # sparse
                "size": pa.array(np.full(len(p.ids), len(words), np.int32)),
                "indices": pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                "values": pa.ListArray.from_arrays(ends, pa.array(n * idf[term])),
            }
            vectors = pa.StructArray.from_arrays([*fields.values()], [*fields])
            yield pa.RecordBatch.from_arrays([p.ids, vectors], names=["post_id", "tfidf"])

    kind = found.schema["post_ids"].dataType.elementType
    return found.mapInArrow(run, T.StructType().add("post_id", kind).add("tfidf", VectorUDT()))


def _fit(stages: list, tokens: DataFrame) -> PipelineModel:
    """Fit on kept tokens: every stage reads them again, but text is parsed once."""
    with _kept(tokens) as kept:
        return Pipeline(stages=stages).fit(kept)


def fit_features(tokens: DataFrame, **limits) -> PipelineModel:
    """Counts and TF-IDF; `limits` are those of `feature_stages`."""
    return _fit(feature_stages(**limits), tokens)


def fit_topics(
    tokens: DataFrame,
    k: int = K,
    max_iter: int = MAX_ITER,
    min_df: float = MIN_DF,
    min_tf: float = MIN_TF,
    vocab_size: int = VOCAB_SIZE,
) -> TopicModel:
    """Tokens or settled bags to TF-IDF and k-means topics, as one model that can be saved."""
    return clusters.learn(tokens, [k], max_iter, min_df, min_tf, vocab_size)[0]


def assign_topics(model: TopicModel, tokens: DataFrame) -> DataFrame:
    """`post_id, topic` of articles' tokens or bags, also of ones the model was not fitted on."""
    return clusters.assign(model, tokens)


def with_any_term(features: DataFrame, column: str = "counts") -> DataFrame:
    """Drop articles with an empty vector; by default they stay and share one topic."""
    return features.filter(F.exists(vector_to_array(column), lambda x: x != 0))


def save_model(model: TopicModel, path: str) -> None:
    clusters.save(SparkSession.active(), model, path)


def load_model(path: str) -> TopicModel:
    return clusters.load(SparkSession.active(), path)


def model_cost(model: TopicModel) -> float:
    """Within-cluster cost of the fit: the sum of squared distances."""
    return model.cost


def model_vocabulary(model: TopicModel) -> list[str]:
    return model.vocabulary


def model_centroids(spark: SparkSession, model: TopicModel, top_k: int = TOP_TERMS) -> DataFrame:
    """`topic, term, weight` of the `top_k` strongest terms of each fitted centre.

    Always `top_k` of them, if the vocabulary has as many; some may weigh nothing.
    """
    terms = np.array(model.vocabulary)
    rows = [
        (topic, str(terms[i]), float(center[i]))
        for topic, center in enumerate(model.weights())
        for i in np.lexsort((terms, -center))[:top_k]
    ]
    return spark.createDataFrame(rows, "topic int, term string, weight double")


def k_sweep(
    tokens: DataFrame,
    ks: list[int],
    max_iter: int = MAX_ITER,
    min_df: float = MIN_DF,
    min_tf: float = MIN_TF,
    vocab_size: int = VOCAB_SIZE,
) -> DataFrame:
    """`k, cost, scaled_cost` for several k over one set of vectors."""
    models = clusters.learn(tokens, ks, max_iter, min_df, min_tf, vocab_size)
    costs = [float(m.cost) for m in models]
    rows = {"k": pa.array(ks, pa.int32()), "cost": costs, "scaled_cost": [c / COST_UNIT for c in costs]}
    return tokens.sparkSession.createDataFrame(pa.table(rows))


def lda_topics(
    tokens: DataFrame,
    k: int = LDA_K,
    max_iter: int = LDA_MAX_ITER,
    top_k: int = TOP_TERMS,
    seed: int = SEED,
    min_df: float = MIN_DF,
    min_tf: float = MIN_TF,
    vocab_size: int = VOCAB_SIZE,
) -> DataFrame:
    """`topic, term, weight, rank`: the strongest terms of each LDA topic, of tokens or settled bags.

    What is dealt out and kept for the iterations are the articles' vectors, not their words.
    """
    found = tokens if bags.is_bags(tokens) else storage.settle(bags.of(tokens))
    vocabulary, idf = clusters.learn_vocabulary(found, min_df, min_tf, vocab_size)
    vectors = dealt(tfidf_vectors(found, vocabulary, idf, min_tf), bags.articles_in(found))
    # Each iteration sees every article, not a sample of them.
    lda = LDA(k=k, maxIter=max_iter, featuresCol="tfidf", seed=seed, subsamplingRate=1.0)
    described = lda.fit(vectors).describeTopics(top_k)
    words = F.array(*[F.lit(word) for word in vocabulary])
    pairs = F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "pair")
    return described.select("topic", pairs).select(
        "topic",
        F.get(words, F.col("pair.termIndices")).alias("term"),
        F.col("pair.termWeights").alias("weight"),
        (F.col("rank") + 1).alias("rank"),
    )


def synonyms(tokens: DataFrame, word: str, n: int = TOP_TERMS, **settings) -> DataFrame:
    """`word, similarity`: the words used most like `word`; see `neighbours.similar_words`."""
    return neighbours.similar_words(tokens, word, n, **settings)


def topic_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("topic").agg(F.count(F.lit(1)).alias("articles"))


def centroids(tfidf: DataFrame, assigned: DataFrame) -> DataFrame:
    """`topic, term, weight`: the mean TF-IDF of a topic's articles, absent terms being 0."""
    sums = (
        tfidf.join(assigned, "post_id").groupBy("topic", "term").agg(F.sum("tfidf").alias("total"))
    )
    return sums.join(topic_sizes(assigned), "topic").select(
        "topic", "term", (F.col("total") / F.col("articles")).alias("weight")
    )


def top_terms(weights: DataFrame, top_k: int = TOP_TERMS) -> DataFrame:
    """`topic, term, weight, rank`: the strongest terms per topic, ties by term."""
    order = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    ranked = weights.select("topic", "term", "weight", F.row_number().over(order).alias("rank"))
    return ranked.filter(F.col("rank") <= top_k)


def dense_centers(vectors: DataFrame) -> DataFrame:
    """`topic, center` as arrays: the mean of `topic, vector` at each position."""
    means = vectors.groupBy("topic").agg(Summarizer.mean(array_to_vector("vector")).alias("mean"))
    return means.select("topic", vector_to_array("mean").alias("center"))


def _all_centers(centers: DataFrame) -> Column:
    """The k centres as one value: a scalar subquery, run once for the whole query.

    k is a setting of the model, not something that grows with the articles: k times the
    vector's length is what every executor holds, as it does for a fitted model too.
    """
    return centers.agg(F.sort_array(F.collect_list(F.struct("topic", "center")))).scalar()


def nearest_centroid(vectors: DataFrame, centers: DataFrame) -> DataFrame:
    """Add `topic` and squared `distance` of the nearest of k centres; ties to the lower topic."""

    def candidate(center: Column) -> Column:
        distance = squared_distance(center["center"], F.col("vector")).alias("distance")
        return F.struct(distance, center["topic"].alias("topic"))

    kept = [c for c in vectors.columns if c not in ("topic", "distance")]
    nearest = F.array_min(F.transform("_centers", candidate)).alias("_nearest")
    with_centers = vectors.withColumn("_centers", _all_centers(centers))
    return with_centers.select(*kept, nearest).select(*kept, "_nearest.*")


def clustering_cost(assigned: DataFrame) -> DataFrame:
    """Sum of the squared distances, plain and scaled, of `nearest_centroid`'s output."""
    cost = F.sum("distance")
    return assigned.agg(cost.alias("cost"), (cost / COST_UNIT).alias("scaled_cost"))


def topic_terms_table(weights: DataFrame, top_k: int = TOP_TERMS) -> DataFrame:
    """The keyword table in its stored form."""
    columns = [F.col(f.name).cast(f.dataType) for f in schemas.TOPIC_TERMS.fields]
    return top_terms(weights, top_k).select(*columns)
