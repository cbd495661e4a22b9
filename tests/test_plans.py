"""What the physical plans must and must not hold."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from topiclens.catalog.queries import QUERIES
from topiclens import schemas
from topiclens.operators import hits as hit_ops
from topiclens.operators import series, terms
from topiclens.operators.articles import with_tokens
from topiclens.plans import testbed

EAGER = {
    "topics_kmeans", "text_to_topic", "stemmed_topics", "classify_new", "model_roundtrip", "k_sweep",
    "topics_lda", "synonyms", "stream_binned_metrics", "kmeans_step",
}
# Queries that apply a model, whose tasks read tokens in batches.
MODELS = {"kmeans_gap", "classified_pages", "model_roundtrip_same", "synonyms_known"}


@contextmanager
def settings(spark, **values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins_and_no_row_at_a_time_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text
    # These two join a single row: the sum of all counts, and the word that is asked for.
    assert "NestedLoopJoin" not in text or name in {"word_pairs", "synonyms_known"}
    assert "BatchEvalPython" not in text
    if name not in MODELS:
        assert "Python" not in text and "InPandas" not in text and "InArrow" not in text


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("session_metrics_by_topic", "ts:timestamp_ntz,user_id:bigint,value:double,props:string"),
        ("device_counts", "event_id:bigint,user_id:bigint,props:string"),
        ("extract_paragraphs", "page_id:bigint,html:string"),
        ("topic_sizes", "source:string"),
    ],
)
def test_scans_read_only_what_is_needed(spark, small, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(QUERIES[name](spark, small))


def test_study_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "hits")
    spark.createDataFrame([], schemas.HITS).write.parquet(path)
    topics = spark.createDataFrame([(1, 2)], schemas.TOPIC_MAP)
    studied = series.study_hits(spark.read.parquet(path))
    text = plan(series.after_cut(series.binned_metrics(studied, topics)))
    assert "GreaterThanOrEqual(ts,2017-03-01" in text and "LessThan(ts,2017-05-01" in text


def test_sessions_need_one_shuffle_after_a_broadcast(spark, small):
    text = plan(QUERIES["session_metrics"](spark, small))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(session_id" in text


def test_tied_starts_are_pruned_before_the_shuffle(spark, small):
    text = plan(QUERIES["session_starts_ties"](spark, small))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "HashAggregate(keys=[session_id" in text


def test_counting_terms_needs_no_shuffle(spark, small):
    text = plan(terms.term_counts(with_tokens(testbed.articles(spark, small))))
    assert "Exchange" not in text


def test_large_topic_map_is_not_broadcast(spark, small):
    """Without room to broadcast, hits are added up per post before they are joined."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        hits, topics = testbed.hits(spark, small), testbed.post_topics(spark, small)
        df = hit_ops.avg_hit_by_topic(hits, topics)
        text = plan(df)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
        join_input = text[text.index("SortMergeJoin") :]
        assert "HashAggregate(keys=[post_id" in join_input
        assert df.count() > 0


@pytest.mark.parametrize(
    "question",
    [
        lambda hits, topics: hit_ops.hits_with_topic(hits, topics),
        lambda hits, topics: hit_ops.session_metrics(hit_ops.hits_with_topic(hits, topics)),
        lambda hits, topics: hit_ops.session_starts(
            hit_ops.hits_with_topic(hits, topics), ties="all"
        ),
    ],
)
def test_a_hot_post_is_split(spark, question):
    """A third of all hits on one post: AQE splits its partition of the join."""
    hits = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("post_id"),
        F.concat(F.lit("session-"), F.col("id")).alias("session_id"),
        F.timestamp_seconds("id").alias("ts"),
        F.lit(0.5).alias("hit_revenue"),
    )
    topics = spark.range(5000).select(
        F.col("id").alias("post_id"), (F.col("id") % 25).cast("int").alias("topic")
    )
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        },
    ):
        df = question(hits, topics)
        assert len(df.collect()) == 400_000
        assert "skew=true" in plan(df)


@pytest.mark.parametrize(
    "name", ["session_metrics", "session_starts", "session_metrics_by_topic", "limit_n"]
)
def test_sessions_are_added_up_without_a_sort(spark, small, name):
    df = QUERIES[name](spark, small)
    df.collect()
    assert "SortAggregate" not in plan(df) and "HashAggregate" in plan(df)


@pytest.mark.parametrize(
    "name",
    [
        "after_cut", "topic_series", "timeframes", "base_series", "topic_daily",
        "revenue_per_view", "rpv_daily", "study_window",
    ],
)
def test_the_study_window_reaches_the_scan(spark, small, name):
    assert "GreaterThanOrEqual(ts," in plan(QUERIES[name](spark, small))


def test_a_hot_term_is_split(spark):
    """The commonest term stands in every article: AQE splits its partition of the join."""
    counts = spark.range(0, 400_000, 1, 8).select(
        F.col("id").alias("post_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5000)).alias("term"),
        F.lit(1).cast("long").alias("tf"),
    )
    table = spark.range(5000).select(
        F.concat(F.lit("t"), F.col("id")).alias("term"), F.lit("s").alias("lemma")
    ).unionByName(spark.createDataFrame([("hot", "h")], "term string, lemma string"))
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        },
    ):
        df = terms.lemmatize(counts, table)
        assert len(df.collect()) == 400_000
        assert "skew=true" in plan(df)
