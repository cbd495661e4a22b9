"""Incremental forms: new files are read once, results stay equal to the batch ones."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from topiclens.functions import clock
from topiclens.plans.articles_to_topics import label_articles


def follow_hits(
    hits: DataFrame,
    out: str,
    checkpoint: str,
    cut: str = clock.CUT,
    width: int = clock.BIN_HOURS,
) -> StreamingQuery:
    """Add up each batch of new hits per post and bin, as one folder per batch.

    A batch that is run again after a failure writes its own folder again, so every
    hit counts once. There is no state to keep and no hit is too late.
    """
    timeframe = clock.hour_bin(clock.hours_since(F.col("ts"), cut), width)

    def add(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("post_id", timeframe.alias("timeframe")).agg(
            F.count(F.lit(1)).alias("views"), F.sum("hit_revenue").alias("revenue")
        )
        sums.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        hits.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def binned_so_far(partials: DataFrame, topics: DataFrame) -> DataFrame:
    """Binned topic metrics from the folders written so far."""
    per_post = partials.groupBy("post_id", "timeframe").agg(
        F.sum("views").alias("views"), F.sum("revenue").alias("revenue")
    )
    return (
        per_post.join(topics, "post_id")
        .groupBy("topic", "timeframe")
        .agg(
            F.count(F.lit(1)).alias("articles"),
            F.sum("views").alias("views"),
            F.sum("revenue").alias("revenue"),
        )
    )


def follow_articles(
    model: PipelineModel,
    articles: DataFrame,
    out: str,
    checkpoint: str,
    lemmas: DataFrame | None = None,
) -> StreamingQuery:
    """Give each new article a topic of a fitted model, one folder of the map per batch."""

    def add(batch: DataFrame, batch_id: int) -> None:
        labelled = label_articles(model, batch, lemmas)
        labelled.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        articles.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_keywords(
    hits: DataFrame, out: str, checkpoint: str, window: str = "1 day", late: str = "2 days"
) -> StreamingQuery:
    """Views per keyword and window of time, as one folder per batch of what has changed.

    State is kept until `late` after a window's end.
    """
    counts = (
        hits.withWatermark("ts", late)
        .groupBy(F.window("ts", window).alias("window"), "keyword")
        .agg(F.count(F.lit(1)).alias("views"))
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.col("window.start").alias("start"), "keyword", "views")
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keyword_views(updates: DataFrame) -> DataFrame:
    """`start, keyword, views`: the latest count of each window."""
    return updates.groupBy("start", "keyword").agg(F.max_by("views", "batch").alias("views"))
