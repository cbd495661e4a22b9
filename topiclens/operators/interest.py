"""Search interest in a topic's keywords, next to its revenue.

`interest` is long: date, keyword, interest (one row per date and keyword).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclens.functions import clock
from topiclens.operators.topics import TOP_TERMS, top_terms


def interest_wide(interest: DataFrame, keywords: list[str]) -> DataFrame:
    """One column per keyword; only dates on which every keyword has a value."""
    wide = interest.groupBy("date").pivot("keyword", keywords).agg(F.max("interest"))
    return wide.dropna(subset=keywords)


def revenue_with_interest(
    daily: DataFrame, wide: DataFrame, cut: str = clock.CUT, last_day: int = clock.LAST_DAY
) -> DataFrame:
    """Daily topic revenue joined on the day to keyword interest, within the study window."""
    dated = wide.withColumn("day", clock.days_since(F.col("date"), cut)).drop("date")
    days = daily.filter(F.col("day").between(0, last_day)).select("topic", "day", "revenue")
    return days.join(dated, "day")


def topic_trendline(
    interest: DataFrame,
    weights: DataFrame,
    top_k: int = TOP_TERMS,
    exclude_topics: tuple[int, ...] = (),
) -> DataFrame:
    """`topic, date, trendline`: interest in the topic's strongest terms, by weight.

    `weights` has topic, term, weight. Topics of a fitted model whose keywords name no
    subject may be left out by their numbers.
    """
    chosen = top_terms(weights, top_k).filter(~F.col("topic").isin(list(exclude_topics)))
    return (
        interest.join(chosen.withColumnRenamed("term", "keyword"), "keyword")
        .groupBy("topic", "date")
        .agg(F.sum(F.col("interest") * F.col("weight")).alias("trendline"))
    )
