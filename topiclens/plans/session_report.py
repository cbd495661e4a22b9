"""What a session earns, by the topic it landed on."""

from __future__ import annotations

from pyspark.sql import DataFrame

from topiclens.operators import hits as hit_ops


def landing_topic_report(hits: DataFrame, topics: DataFrame, ties: str = "first") -> DataFrame:
    """`topic, sessions, revenue, views, revenue_per_session`."""
    combined = hit_ops.hits_with_topic(
        hits.select("session_id", "ts", "post_id", "hit_revenue"), topics
    )
    return hit_ops.session_metrics_by_topic(hit_ops.session_metrics(combined, ties))
