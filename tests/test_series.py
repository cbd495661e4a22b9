from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from topiclens.operators import interest as interest_ops
from topiclens.operators import regression, series
from topiclens.plans.trend_report import revenue_table


@pytest.fixture(scope="module")
def binned(spark):
    rows = [
        (1, -4, 1, 1, 9.0),
        (1, 0, 1, 4, 2.0),
        (1, 24, 2, 4, 6.0),
        (2, 8, 1, 0, 0.0),
        (3, -8, 1, 2, 1.0),
    ]
    schema = "topic int, timeframe int, articles long, views long, revenue double"
    return spark.createDataFrame(rows, schema)


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}


def test_after_cut_keeps_the_cut(binned):
    assert as_set(series.after_cut(binned), "timeframe") == {(0,), (24,), (8,)}


def test_study_window_is_inclusive(spark):
    days = spark.createDataFrame([(-1,), (0,), (60,), (61,)], "day int")
    assert as_set(series.study_window(days), "day") == {(0,), (60,)}


@pytest.mark.parametrize("width", [4, 5])
def test_study_hits_lose_no_bin_of_the_window(spark, width):
    hits = spark.range(-50, 200).select(
        F.timestamp_seconds(F.unix_timestamp(F.lit("2017-03-01 00:00:00")) + F.col("id") * 1801)
        .alias("ts"),
        F.lit(1).cast("long").alias("post_id"),
        F.lit(0.5).alias("hit_revenue"),
    )
    topics = spark.createDataFrame([(1, 9)], "post_id long, topic int")

    def days(rows):
        binned = series.binned_metrics(rows, topics, width=width)
        daily = series.topic_daily(series.after_cut(binned))
        return as_set(series.study_window(daily, 1), "day", "topic", "views", "revenue")

    assert days(series.study_hits(hits, last_day=1, width=width)) == days(hits)


def test_topic_series_of_some_topics(binned):
    assert series.topic_series(binned, [1]).count() == 3
    assert series.topic_series(binned).count() == 5


def test_totals_do_not_add_up_the_key(binned):
    daily = series.topic_daily(binned)
    assert set(daily.columns) == {"day", "topic", "articles", "views", "revenue"}
    assert (-1, 1, 9.0) in as_set(daily, "day", "topic", "revenue")


def test_ratio_without_views_is_null(binned):
    ratios = series.revenue_per_view(series.after_cut(binned))
    assert as_set(ratios, "topic", "revenue_per_view") == {(1, 1.0), (2, None)}


def test_dense_series_fills_gaps_and_empty_topics(binned):
    dense = series.dense_series(binned, 0, 24)
    assert dense.count() == 3 * 7
    assert as_set(dense.filter("views > 0 OR revenue > 0"), "topic", "timeframe", "views") == {
        (1, 0, 4), (1, 24, 4),
    }
    assert dense.filter("topic = 3").agg(F.sum("views")).first()[0] == 0
    assert dense.dropna().count() == dense.count()


def test_standardized_uses_the_population_deviation(spark):
    rows = [(1, 0, 1, 1, 1.0), (1, 4, 3, 1, 3.0)]
    schema = "topic int, timeframe int, articles long, views long, revenue double"
    scaled = series.standardized_series(spark.createDataFrame(rows, schema))
    assert as_set(scaled, "timeframe", "articles", "views", "revenue") == {
        (0, -1.0, 0.0, -1.0), (4, 1.0, 0.0, 1.0),
    }


@pytest.fixture(scope="module")
def interest(spark):
    rows = [
        (date(2017, 3, 1), "kim", 10.0),
        (date(2017, 3, 2), "kim", 20.0),
        (date(2017, 3, 3), "kim", 40.0),
        (date(2017, 3, 1), "rob", 1.0),
        (date(2017, 3, 3), "rob", 3.0),
    ]
    return spark.createDataFrame(rows, "date date, keyword string, interest double")


@pytest.mark.parametrize("keywords", [["kim"], ["kim", "rob"]])
def test_interest_wide_drops_dates_with_a_gap(interest, keywords):
    wide = interest_ops.interest_wide(interest, keywords)
    assert wide.columns == ["date", *keywords]
    assert wide.count() == (3 if keywords == ["kim"] else 2)


def test_revenue_joins_on_the_day_not_the_row(spark, interest):
    hits = spark.createDataFrame(
        [(datetime(2017, 3, d, 3), 10, 1.0 * d) for d in (2, 3)],
        "ts timestamp, post_id long, hit_revenue double",
    )
    topics = spark.createDataFrame([(10, 17)], "post_id long, topic int")
    table = revenue_table(hits, topics, interest, ["kim"])
    assert as_set(table, "topic", "day", "revenue", "kim") == {
        (17, 1, 2.0, 20.0), (17, 2, 3.0, 40.0),
    }


def test_trendline_weighs_the_top_terms(spark, interest):
    weights = spark.createDataFrame(
        [(2, "kim", 0.5), (2, "rob", 2.0), (2, "low", 0.1), (1, "kim", 1.0), (3, "kim", 1.0)],
        "topic int, term string, weight double",
    )
    assert interest_ops.topic_trendline(interest, weights, top_k=2).filter("topic = 1").count() == 3
    trend = interest_ops.topic_trendline(interest, weights, top_k=2, exclude_topics=(1,))
    assert as_set(trend, "topic", "date", "trendline") == {
        (2, date(2017, 3, 1), 7.0), (2, date(2017, 3, 2), 10.0), (2, date(2017, 3, 3), 26.0),
        (3, date(2017, 3, 1), 10.0), (3, date(2017, 3, 2), 20.0), (3, date(2017, 3, 3), 40.0),
    }


def test_exact_line_is_found(spark):
    rows = [(1, d, 3.0 + 2.0 * d - 0.5 * (d % 3), float(d % 3), 1.0) for d in range(10)]
    df = spark.createDataFrame(rows, "topic int, day int, revenue double, kim double, flat double")
    fits = regression.revenue_ols(df, ["day", "kim", "flat"]).collect()
    found = {row.variable: row.coefficient for row in fits}
    expected = {"intercept": 3.0, "day": 2.0, "kim": -0.5, "flat": 0.0}
    assert found == pytest.approx(expected, abs=1e-9)
    assert all(row.r2 == pytest.approx(1.0) and row.days == 10 for row in fits)


def fit_of(spark, rows, names):
    """Coefficients of (x..., y) rows, in two parts so that moments are merged."""
    schema = "topic int, day int, " + ", ".join(f"{n} double" for n in [*names, "revenue"])
    df = spark.createDataFrame([(1, d % 60, *r) for d, r in enumerate(rows)], schema).repartition(2)
    found = regression.revenue_ols(df, names).collect()
    return {r.variable: r.coefficient for r in found}, found[0].r2


@pytest.mark.parametrize(
    "origin,unit,intercept,slope",
    [(0, 1, 0, 5), (1e9, 1, 0, 5), (0, 1e-8, 3, 2e8), (-1e9, 1e-1, 7, 1e3), (1e6, 1e6, 1e-3, 1e-9), (0, 1e-150, 1, 1e150)],
)
def test_lines_in_any_unit_and_far_from_zero(spark, origin, unit, intercept, slope):
    xs = [float(origin + d * unit) for d in range(40)]
    found, r2 = fit_of(spark, [(x, float(intercept + slope * x)) for x in xs], ["x"])
    large = abs(slope * origin) + abs(slope * unit) + abs(intercept)
    assert found["x"] == pytest.approx(slope, rel=1e-8)
    assert found["intercept"] == pytest.approx(intercept, abs=1e-8 * large)
    assert r2 == pytest.approx(1.0, abs=1e-9)


def test_many_regressors_equal_a_library(spark):
    import numpy as np

    r = np.random.default_rng(5)
    x = r.normal(size=(200, 5)) * [1, 1e-6, 1e6, 3, 1] + [0, 1, 1e9, -5, 1e3]
    y = x @ [1, 1e6, 1e-6, 0, -2] + r.normal(size=200)
    names = [f"x{i}" for i in range(5)]
    found, r2 = fit_of(spark, [(*map(float, a), float(b)) for a, b in zip(x, y)], names)
    mean = x.mean(axis=0)
    scale = x.std(axis=0)
    wanted = np.linalg.lstsq((x - mean) / scale, y - y.mean(), rcond=None)[0] / scale
    assert [found[n] for n in names] == pytest.approx(wanted.tolist(), rel=1e-7, abs=1e-12)
    rest = y - y.mean() - (x - mean) @ wanted
    assert r2 == pytest.approx(1 - rest.var() / y.var(), rel=1e-9)


def test_dependent_and_constant_variables(spark):
    import math

    rows = [(float(d), 2.0 * d + 1, 0.1 + 0.2, float(d % 3), 4.0 * d + d % 3) for d in range(12)]
    found, r2 = fit_of(spark, rows, ["a", "twice", "flat", "third"])
    assert found == pytest.approx({"intercept": 0, "a": 4, "twice": 0, "flat": 0, "third": 1}, abs=1e-9)
    assert r2 == pytest.approx(1.0)
    found, r2 = fit_of(spark, [(float(d), 0.3) for d in range(7)], ["a"])
    assert found == pytest.approx({"intercept": 0.3, "a": 0}) and math.isnan(r2)
    found, r2 = fit_of(spark, [(5.0, 2.0)], ["a"])
    assert found == {"intercept": 2.0, "a": 0.0} and math.isnan(r2)


def test_residuals_and_r2(spark):
    rows = [(t, d, float((d * 7 + t) % 5), float(d % 4)) for t in (1, 2) for d in range(12)]
    df = spark.createDataFrame(rows, "topic int, day int, revenue double, kim double")
    for row in (
        regression.revenue_predicted(df, ["day", "kim"])
        .groupBy("topic")
        .agg(F.sum(F.col("actual") - F.col("predicted")).alias("rest"), F.max("r2").alias("r2"))
        .collect()
    ):
        assert abs(row.rest) < 1e-9 and 0 <= row.r2 <= 1


def test_single_regressor_equals_the_general_fit(spark):
    rows = [(1, d, float((d * 7) % 5), float(d % 4)) for d in range(12)]
    df = spark.createDataFrame(rows, "topic int, day int, revenue double, kim double")
    line = regression.revenue_regr(df, "kim").first()
    fit = {r.variable: r for r in regression.revenue_ols(df, ["kim"]).collect()}
    assert line.slope == pytest.approx(fit["kim"].coefficient)
    assert line.intercept == pytest.approx(fit["intercept"].coefficient)
    assert line.r2 == pytest.approx(fit["kim"].r2)
