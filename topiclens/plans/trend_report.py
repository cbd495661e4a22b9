"""A topic's daily revenue against search interest in its keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame

from topiclens.functions import clock
from topiclens.operators import interest as interest_ops
from topiclens.operators import regression, series


def revenue_table(
    hits: DataFrame,
    topics: DataFrame,
    interest: DataFrame,
    keywords: list[str],
    cut: str = clock.CUT,
    last_day: int = clock.LAST_DAY,
) -> DataFrame:
    """`day, topic, revenue` and one interest column per keyword."""
    studied = series.study_hits(hits, cut, last_day)
    binned = series.after_cut(series.binned_metrics(studied, topics, cut))
    wide = interest_ops.interest_wide(interest, keywords)
    return interest_ops.revenue_with_interest(series.topic_daily(binned), wide, cut, last_day)


def revenue_model(table: DataFrame, keywords: list[str]) -> DataFrame:
    return regression.revenue_ols(table, ["day", *keywords])


def predicted_revenue(table: DataFrame, keywords: list[str]) -> DataFrame:
    return regression.revenue_predicted(table, ["day", *keywords])
