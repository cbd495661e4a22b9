"""Click hits joined to topics: sessions, devices, revenue.

`hits` has session_id, ts, post_id, device_type, hit_revenue; `topics` has one row
(post_id, topic) per post. No side is force-broadcast: the planner broadcasts the
topic map while it is small and otherwise shuffles, where AQE splits hot posts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hits_with_topic(hits: DataFrame, topics: DataFrame) -> DataFrame:
    """Each hit with the topic of its post; hits of posts without a topic fall out."""
    return hits.join(topics, "post_id")


def topic_rollup(
    hits: DataFrame, topics: DataFrame, dims: list[str], /, **sums: Column
) -> DataFrame:
    """Aggregate hits by topic and `dims`, adding up the aggregates `sums`.

    Hits are added up per post before the join: the join then handles one row per post
    and `dims`, however many hits a post has. `articles` counts the posts.
    """
    per_post = hits.groupBy("post_id", *dims).agg(
        *[aggregate.alias(name) for name, aggregate in sums.items()]
    )
    return (
        per_post.join(topics, "post_id")
        .groupBy("topic", *dims)
        .agg(
            F.count(F.lit(1)).alias("articles"),
            *[F.sum(name).alias(name) for name in sums],
        )
    )


def session_first_ts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("session_id").agg(F.min("ts").alias("first_ts"))


# More than twice the largest id, so that ids of the same moment keep their order.
MOMENT = Decimal(2**65)


def _moment() -> Column:
    """Orders hits by time, then by post, as one number of fixed width.

    Aggregates of numbers update their buffers in place, so hits need no sort.
    """
    micros = F.unix_micros("ts").cast("decimal(18,0)")
    return micros * F.lit(MOMENT) + F.col("post_id").cast("decimal(20,0)")


def _landing() -> dict[str, Column]:
    """Post and topic of the first hit; hits at the same time are ordered by post."""
    return {
        "first_moment": F.min(_moment()),
        "post_id": F.min_by("post_id", _moment()),
        "topic": F.min_by("topic", _moment()),
    }


def session_starts(combined: DataFrame, ties: str = "first") -> DataFrame:
    """`session_id, post_id, topic` of each session's landing hit.

    `ties="all"` keeps every distinct post that shares the first moment.
    """
    if ties == "first":
        landing = [column.alias(name) for name, column in _landing().items()]
        starts = combined.groupBy("session_id").agg(*landing)
        return starts.filter("first_moment IS NOT NULL").drop("first_moment")
    # However many hits share the first moment, one row per post is left of them; and
    # rank() = 1 is pruned before the shuffle on the session.
    posts = combined.groupBy("session_id", "post_id", "topic").agg(F.min("ts").alias("ts"))
    order = Window.partitionBy("session_id").orderBy("ts")
    ranked = posts.filter(F.col("ts").isNotNull()).withColumn("_rank", F.rank().over(order))
    return ranked.filter("_rank = 1").select("session_id", "post_id", "topic")


def session_metrics(combined: DataFrame, ties: str = "first") -> DataFrame:
    """`session_id, topic, revenue, views` with the topic of the landing hit.

    One shuffle on the session: the landing hit and the sums come from the same
    aggregate. With `ties="all"` a session counts once per landing post.
    """
    sums = [F.sum("hit_revenue").alias("revenue"), F.count("post_id").alias("views")]
    if ties == "first":
        landing = [column.alias(name) for name, column in _landing().items()]
        sessions = combined.groupBy("session_id").agg(*landing, *sums)
        return sessions.filter("first_moment IS NOT NULL").select(
            "session_id", "topic", "revenue", "views"
        )
    starts = session_starts(combined, ties).groupBy("session_id", "topic").count()
    totals = combined.groupBy("session_id").agg(*sums)
    return starts.join(totals, "session_id").select(
        "session_id",
        "topic",
        (F.col("revenue") * F.col("count")).alias("revenue"),
        (F.col("views") * F.col("count")).alias("views"),
    )


def session_metrics_by_topic(sessions: DataFrame) -> DataFrame:
    """Sessions, revenue and views by landing topic."""
    return sessions.groupBy("topic").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("revenue").alias("revenue"),
        F.sum("views").alias("views"),
        F.try_divide(F.sum("revenue"), F.count(F.lit(1))).alias("revenue_per_session"),
    )


def avg_hit_by_topic(hits: DataFrame, topics: DataFrame) -> DataFrame:
    totals = topic_rollup(
        hits, topics, [], revenue=F.sum("hit_revenue"), paid=F.count("hit_revenue")
    )
    return totals.select("topic", F.try_divide("revenue", "paid").alias("avg_hit"))


def device_counts(hits: DataFrame, topics: DataFrame, devices: list[str]) -> DataFrame:
    """Hits per topic for each device, one column `<device>_hits` per device, and `hits`."""
    counts = {
        f"{device}_hits": F.count_if(F.col("device_type") == device) for device in devices
    }
    totals = topic_rollup(hits, topics, [], hits=F.count(F.lit(1)), **counts)
    return totals.select("topic", *counts, "hits")


def device_share(hits: DataFrame, topics: DataFrame, device: str) -> DataFrame:
    """Share of a topic's hits that come from a device, and of all others."""
    counts = device_counts(hits, topics, [device])
    share = F.try_divide(f"{device}_hits", "hits")
    return counts.select(
        "topic", share.alias("device_share"), (1 - share).alias("other_share")
    )


def device_outer_join(hits: DataFrame, topics: DataFrame, left: str, right: str) -> DataFrame:
    """Full outer join of two devices' hit counts on the topic.

    One aggregate gives the same rows: a topic is there if either device has a hit,
    with null for the other.
    """
    counts = device_counts(hits, topics, [left, right])
    a, b = F.col(f"{left}_hits"), F.col(f"{right}_hits")
    return counts.filter((a > 0) | (b > 0)).select(
        "topic",
        F.nullif(a, F.lit(0)).alias(f"{left}_hits"),
        F.nullif(b, F.lit(0)).alias(f"{right}_hits"),
    )


def topic_weekday(hits: DataFrame, topics: DataFrame) -> DataFrame:
    """Views and revenue by topic and day of the week (Monday is 0)."""
    days = hits.withColumn("weekday", F.weekday("ts"))
    return topic_rollup(
        days, topics, ["weekday"], views=F.count(F.lit(1)), revenue=F.sum("hit_revenue")
    )


def topic_lifespan(hits: DataFrame, topics: DataFrame) -> DataFrame:
    """How long a topic's articles are read: age at view in whole hours.

    Views are first counted per hour of age, so that the exact percentiles keep one
    entry per hour, not per hit.
    """
    seconds = F.unix_timestamp("ts") - F.unix_timestamp("post_published")
    aged = hits.withColumn("age_hours", F.floor(seconds / 3600)).filter("age_hours >= 0")
    ages = topic_rollup(aged, topics, ["age_hours"], views=F.count(F.lit(1)))
    views = F.sum("views")
    return ages.groupBy("topic").agg(
        views.alias("views"),
        (F.sum(F.col("age_hours") * F.col("views")) / views).alias("mean_age"),
        F.percentile("age_hours", 0.5, F.col("views")).alias("median_age"),
        F.percentile("age_hours", 0.9, F.col("views")).alias("p90_age"),
        F.max("age_hours").alias("last_age"),
    )
