from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from sunledger.functions import timeops
from sunledger.operators.calendar_dim import easter_sunday, holiday_dim


def walls(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t STRING").select(
        F.col("t"), F.to_timestamp_ntz("t").alias("wall")
    )


def localized(spark, *texts):
    rows = walls(spark, *texts).select("t", timeops.localize_wall_clock("wall").cast("string").alias("u")).collect()
    return {r.t: r.u for r in rows}


def test_spring_gap_moves_to_the_first_valid_instant(spark):
    got = localized(
        spark, "2019-03-31 01:00:00", "2019-03-31 02:00:00", "2019-03-31 02:30:00", "2019-03-31 03:00:00"
    )
    assert got == {
        "2019-03-31 01:00:00": "2019-03-31 00:00:00",
        "2019-03-31 02:00:00": "2019-03-31 01:00:00",
        "2019-03-31 02:30:00": "2019-03-31 01:00:00",
        "2019-03-31 03:00:00": "2019-03-31 01:00:00",
    }


def test_autumn_hour_is_standard_time(spark):
    got = localized(spark, "2019-10-27 01:00:00", "2019-10-27 02:00:00", "2019-10-27 02:30:00", "2019-10-27 03:00:00")
    assert got == {
        "2019-10-27 01:00:00": "2019-10-26 23:00:00",
        "2019-10-27 02:00:00": "2019-10-27 01:00:00",
        "2019-10-27 02:30:00": "2019-10-27 01:30:00",
        "2019-10-27 03:00:00": "2019-10-27 02:00:00",
    }


def test_five_years_of_hours(spark):
    start = F.unix_seconds(F.lit("2015-01-01").cast("timestamp"))
    hours = spark.range(43_824).select(F.timestamp_seconds(start + F.col("id") * 3600).alias("ts_utc"))
    utc = hours.select(timeops.localize_wall_clock(F.col("ts_utc").cast("timestamp_ntz")).alias("ts_utc"))
    assert utc.count() == 43_824
    assert utc.distinct().count() == 43_819
    assert utc.distinct().join(hours, "ts_utc").count() == 43_818


def test_utc_to_local_on_both_sides_of_the_change(spark):
    rows = spark.sql(
        "SELECT explode(array(timestamp'2019-03-31 00:59:00', timestamp'2019-03-31 01:00:00', "
        "timestamp'2019-10-27 00:30:00', timestamp'2019-10-27 01:30:00')) AS ts_utc"
    ).select(timeops.utc_to_local("ts_utc").alias("local"))
    assert rows.schema["local"].dataType.typeName() == "timestamp_ntz"
    assert [r.local for r in rows.collect()] == [
        datetime(2019, 3, 31, 1, 59),
        datetime(2019, 3, 31, 3, 0),
        datetime(2019, 10, 27, 2, 30),
        datetime(2019, 10, 27, 2, 30),
    ]


def test_calendar_parts(spark):
    row = (
        walls(spark, "2024-02-25 13:00:00")
        .select(
            timeops.hour_of_day("wall"),
            timeops.day_of_year("wall"),
            timeops.day_of_week("wall"),
            timeops.is_weekend(timeops.day_of_week("wall")),
            timeops.month_start(timeops.local_date("wall")),
            timeops.season("wall"),
        )
        .first()
    )
    assert tuple(row) == (13, 56, 0, True, date(2024, 2, 1), "winter")


def test_easter(spark):
    years = spark.createDataFrame([(y,) for y in (2015, 2016, 2017, 2018, 2019, 1961, 2038)], "year INT")
    got = [r[0] for r in years.select(easter_sunday(F.col("year"))).collect()]
    assert got == [
        date(2015, 4, 5),
        date(2016, 3, 27),
        date(2017, 4, 16),
        date(2018, 4, 1),
        date(2019, 4, 21),
        date(1961, 4, 2),
        date(2038, 4, 25),
    ]


def test_holidays_of_a_year(spark):
    got = sorted(r[0] for r in holiday_dim(spark, 2019, 2019).collect())
    assert got == [
        date(2019, 1, 1),
        date(2019, 1, 2),
        date(2019, 4, 19),
        date(2019, 4, 22),
        date(2019, 5, 30),
        date(2019, 6, 10),
        date(2019, 8, 1),
        date(2019, 12, 25),
        date(2019, 12, 26),
    ]
