from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from topiclens.functions import clock


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("ts", "seconds"),
    [("2017-03-01 00:00:00", 0), ("2017-02-28 23:59:59", -1), ("2017-03-02 01:00:00", 90000)],
)
def test_seconds_since(spark, ts, seconds):
    assert one(spark, clock.seconds_since(F.lit(ts))) == seconds
    assert one(spark, clock.hours_since(F.lit(ts))) == seconds / 3600


@pytest.mark.parametrize(
    ("day", "days"), [("2017-03-01", 0), ("2017-02-28", -1), ("2017-04-30", 60), ("2017-05-01", 61)]
)
def test_days_since(spark, day, days):
    assert one(spark, clock.days_since(F.lit(day))) == days


@pytest.mark.parametrize(
    ("hour", "day", "start"),
    [(-1.0, -1, -4), (0.0, 0, 0), (23.9, 0, 20), (24.0, 1, 24), (-24.0, -1, -24), (-0.1, -1, -4)],
)
def test_hour_to_day_floors(spark, hour, day, start):
    assert one(spark, clock.hour_to_day(F.lit(hour))) == day
    assert one(spark, clock.hour_bin(F.lit(hour))) == start


def test_offsets_back_to_dates(spark):
    # Hour offsets count from the cut itself, not from the day before it.
    assert one(spark, clock.day_to_date(F.lit(0))) == date(2017, 3, 1)
    assert one(spark, clock.day_to_date(F.lit(60))) == date(2017, 4, 30)
    assert one(spark, clock.hour_to_timestamp(F.lit(4))) == datetime(2017, 3, 1, 4)
