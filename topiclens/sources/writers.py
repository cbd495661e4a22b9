"""Writers. Every executor writes its own part; nothing passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from topiclens.operators.articles import non_empty, with_page_status


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_articles_csv(articles: DataFrame, path: str, remove_empty: bool = True) -> None:
    """`post_id, text` as CSV with a header."""
    kept = non_empty(articles) if remove_empty else articles
    kept.select("post_id", "text").write.mode("overwrite").csv(path, header=True, escape='"')


def write_topic_map(assigned: DataFrame, path: str) -> None:
    """The one topic map that every later stage reads."""
    write_table(assigned.select("post_id", "topic"), path)


def write_by_topic(df: DataFrame, path: str) -> None:
    """One folder per topic. The rebalance lets AQE split a topic that is too large."""
    rows = df.hint("rebalance", "topic")
    rows.write.mode("overwrite").partitionBy("topic").parquet(path)


def write_pages_by_status(crawl: DataFrame, path: str) -> None:
    """Fetched, failed and redirected pages as three folders, in one pass."""
    pages = with_page_status(crawl)
    pages.write.mode("overwrite").partitionBy("page_status").parquet(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Give a frame a name in SQL."""
    df.createOrReplaceTempView(name)
    return df
