"""Topic metrics over time: bins, days, ratios, dense and standardised series.

A series has one row per topic and bin of the study window. That is small whatever
the number of hits, so only `binned_metrics` has to cope with size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclens.functions import clock
from topiclens.operators.hits import topic_rollup

MEASURES = ["articles", "views", "revenue"]


def study_hits(
    hits: DataFrame,
    cut: str = clock.CUT,
    last_day: int = clock.LAST_DAY,
    width: int = clock.BIN_HOURS,
) -> DataFrame:
    """Hits from the cut to the end of the last day's last bin.

    Bins of other hits would be dropped later; here the condition reaches the scan.
    """
    start = F.lit(cut).cast("timestamp")
    hours = -(-(last_day + 1) * 24 // width) * width
    end = start + F.make_interval(hours=F.lit(hours))
    return hits.filter((F.col("ts") >= start) & (F.col("ts") < end))


def hits_from_cut(hits: DataFrame, cut: str = clock.CUT) -> DataFrame:
    """Hits from the cut on: those whose bin is 0 or later; the condition reaches the scan."""
    return hits.filter(F.col("ts") >= F.lit(cut).cast("timestamp"))


def binned_metrics(
    hits: DataFrame, topics: DataFrame, cut: str = clock.CUT, width: int = clock.BIN_HOURS
) -> DataFrame:
    """`topic, timeframe, articles, views, revenue` per bin of `width` hours from the cut."""
    bins = hits.withColumn("timeframe", clock.hour_bin(clock.hours_since(F.col("ts"), cut), width))
    return topic_rollup(
        bins, topics, ["timeframe"], views=F.count(F.lit(1)), revenue=F.sum("hit_revenue")
    ).select("topic", "timeframe", *MEASURES)


def after_cut(binned: DataFrame) -> DataFrame:
    return binned.filter(F.col("timeframe") >= 0)


def study_window(df: DataFrame, last_day: int = clock.LAST_DAY, day: str = "day") -> DataFrame:
    return df.filter(F.col(day).between(0, last_day))


def timeframes(binned: DataFrame) -> DataFrame:
    return binned.select("timeframe").distinct().orderBy("timeframe")


def topic_series(binned: DataFrame, topics: list[int] | None = None) -> DataFrame:
    """The series of every topic, or of some, in one frame keyed by topic."""
    chosen = binned if topics is None else binned.filter(F.col("topic").isin(topics))
    return chosen.select("topic", "timeframe", "views", "articles", "revenue")


def _totals(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def base_series(binned: DataFrame) -> DataFrame:
    """Totals over all topics, in time order."""
    return _totals(binned, "timeframe").orderBy("timeframe")


def topic_daily(binned: DataFrame) -> DataFrame:
    """Sums per day and topic."""
    days = binned.withColumn("day", clock.hour_to_day(F.col("timeframe")))
    return _totals(days, "day", "topic")


def revenue_per_view(binned: DataFrame) -> DataFrame:
    totals = _totals(binned, "topic")
    return totals.select("topic", F.try_divide("revenue", "views").alias("revenue_per_view"))


def rpv_daily(binned: DataFrame) -> DataFrame:
    ratio = F.try_divide("revenue", "views").alias("revenue_per_view")
    return topic_daily(binned).select("topic", "day", ratio)


def dense_series(
    binned: DataFrame, first: int, last: int, width: int = clock.BIN_HOURS
) -> DataFrame:
    """One row per topic and bin from `first` to `last`, 0 where the topic has no hits.

    Each topic's bins are looked up in a map that holds at most one entry per bin of
    the window: no grid is joined and the bins are made only once.
    """
    entry = F.struct(F.col("timeframe"), F.struct(*MEASURES))
    # A topic without hits in the window has an empty map, so a series of zeros.
    in_window = F.when(F.col("timeframe").between(first, last), entry)
    topics = binned.groupBy("topic").agg(
        F.map_from_entries(F.collect_list(in_window)).alias("seen")
    )
    bins = F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(width)))
    grid = topics.select("topic", "seen", bins.alias("timeframe"))
    found = F.try_element_at("seen", F.col("timeframe"))
    return grid.select("topic", "timeframe", found.alias("found")).select(
        "topic",
        "timeframe",
        *[F.coalesce(F.col("found")[m], F.lit(0)).alias(m) for m in MEASURES],
    )


def standardized_series(binned: DataFrame) -> DataFrame:
    """Measures with mean 0 and population standard deviation 1 within each topic."""
    topic = Window.partitionBy("topic")
    scaled = []
    for m in MEASURES:
        centred = F.col(m) - F.avg(m).over(topic)
        spread = F.stddev_pop(m).over(topic)
        # A constant measure is only centred.
        scaled.append((centred / F.when(spread == 0, 1.0).otherwise(spread)).alias(m))
    return binned.select("topic", "timeframe", *scaled)


def with_dates(binned: DataFrame, cut: str = clock.CUT) -> DataFrame:
    """Add the calendar date of each bin."""
    day = clock.hour_to_day(F.col("timeframe"))
    return binned.withColumn("date", clock.day_to_date(day, cut))
