"""Sessions, devices and rollups on hand-made hits."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from topiclens.operators import hits as ops
from topiclens.plans.session_report import landing_topic_report


def at(minute):
    return datetime(2017, 3, 1, 12, minute)


@pytest.fixture(scope="module")
def hits(spark):
    rows = [
        # Two posts at the first moment, topics 1 and 2.
        ("tie", at(0), 10, "smartphone", 1.0),
        ("tie", at(0), 20, "desktop", 2.0),
        ("tie", at(5), 30, "smartphone", 4.0),
        # The first hit has no topic, so the second one is where the session landed.
        ("lost", at(0), 99, "desktop", 100.0),
        ("lost", at(1), 30, "desktop", 8.0),
        # No revenue, no post, only un-topiced posts.
        ("free", at(2), 10, "tablet", None),
        ("free", at(3), None, "tablet", 5.0),
        ("none", at(4), 99, "smartphone", 7.0),
        # Both first hits are on topic 3.
        ("same", at(0), 30, "tablet", 1.0),
        ("same", at(0), 31, "tablet", 1.0),
    ]
    return spark.createDataFrame(
        rows,
        "session_id string, ts timestamp, post_id long, device_type string, hit_revenue double",
    )


@pytest.fixture(scope="module")
def topics(spark):
    return spark.createDataFrame(
        [(10, 1), (20, 2), (30, 3), (31, 3), (40, 4)], "post_id long, topic int"
    )


@pytest.fixture(scope="module")
def combined(hits, topics):
    return ops.hits_with_topic(hits, topics)


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}


def test_hits_without_topic_fall_out(combined):
    assert combined.count() == 7


def test_starts(combined):
    assert as_set(ops.session_starts(combined), "session_id", "post_id", "topic") == {
        ("tie", 10, 1), ("lost", 30, 3), ("free", 10, 1), ("same", 30, 3),
    }


def test_starts_with_all_ties(combined):
    starts = ops.session_starts(combined, ties="all")
    assert as_set(starts, "session_id", "post_id", "topic") == {
        ("tie", 10, 1), ("tie", 20, 2), ("lost", 30, 3), ("free", 10, 1),
        ("same", 30, 3), ("same", 31, 3),
    }


def test_metrics_count_each_session_once(combined):
    metrics = ops.session_metrics(combined)
    assert as_set(metrics, "session_id", "topic", "revenue", "views") == {
        ("tie", 1, 7.0, 3), ("lost", 3, 8.0, 1), ("free", 1, None, 1), ("same", 3, 2.0, 2),
    }


def test_metrics_with_all_ties_equal_the_join(combined):
    metrics = ops.session_metrics(combined, ties="all")
    joined = (
        ops.session_starts(combined, ties="all")
        .withColumnRenamed("post_id", "landing")
        .join(combined.drop("topic"), "session_id")
        .groupBy("session_id", "topic")
        .agg(F.sum("hit_revenue").alias("revenue"), F.count("post_id").alias("views"))
    )
    columns = ("session_id", "topic", "revenue", "views")
    assert as_set(metrics, *columns) == as_set(joined, *columns)


def test_report(hits, topics):
    report = landing_topic_report(hits, topics)
    assert as_set(report, "topic", "sessions", "revenue", "views", "revenue_per_session") == {
        (1, 2, 7.0, 4, 3.5),
        (3, 2, 10.0, 3, 5.0),
    }


def test_ids_above_float_precision_stay_apart(spark):
    hits = spark.createDataFrame(
        [("s", at(0), 16777217, 1.0)],
        "session_id string, ts timestamp, post_id long, hit_revenue double",
    )
    topics = spark.createDataFrame([(16777216, 1), (16777217, 2)], "post_id long, topic int")
    assert as_set(ops.hits_with_topic(hits, topics), "topic") == {(2,)}


def test_average_ignores_missing_revenue(hits, topics):
    assert as_set(ops.avg_hit_by_topic(hits, topics), "topic", "avg_hit") == {
        (1, 1.0), (2, 2.0), (3, 14.0 / 4),
    }


def test_devices(hits, topics):
    outer = ops.device_outer_join(hits, topics, "smartphone", "desktop")
    assert as_set(outer, "topic", "smartphone_hits", "desktop_hits") == {
        (1, 1, None), (2, None, 1), (3, 1, 1),
    }
    shares = ops.device_share(hits, topics, "tablet")
    assert as_set(shares, "topic", "device_share", "other_share") == {
        (1, 0.5, 0.5), (2, 0.0, 1.0), (3, 0.5, 0.5),
    }


def test_rollup_before_the_join_equals_after(hits, topics, combined):
    early = ops.topic_weekday(hits, topics)
    late = combined.groupBy("topic", F.weekday("ts").alias("weekday")).agg(
        F.countDistinct("post_id").alias("articles"),
        F.count("*").alias("views"),
        F.sum("hit_revenue").alias("revenue"),
    )
    columns = ("topic", "weekday", "articles", "views", "revenue")
    assert as_set(early, *columns) == as_set(late, *columns)


def test_lifespan(spark, topics):
    published = at(0)
    ages = [0, 1, 1, 5, -3]
    hits = spark.createDataFrame(
        [(published.replace(hour=12 + age), 10, published) for age in ages],
        "ts timestamp, post_id long, post_published timestamp",
    )
    row = ops.topic_lifespan(hits, topics).first()
    assert (row.views, row.mean_age, row.median_age, row.last_age) == (4, 1.75, 1.0, 5)
