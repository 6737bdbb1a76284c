"""Public-holiday dimension from a rule, so any range of years can be built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (month, day) holidays, and offsets in days from Easter Sunday.
FIXED_HOLIDAYS = ((1, 1), (1, 2), (8, 1), (12, 25), (12, 26))
EASTER_OFFSETS = (-2, 1, 39, 50)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous (Meeus/Jones/Butcher) rule, in whole-number column arithmetic."""
    whole = lambda a, n: F.floor(a / n)
    golden = year % 19
    century, of_century = whole(year, 100), year % 100
    skipped = century - whole(century, 4) - whole(century - whole(century + 8, 25) + 1, 3)
    epact = (golden * 19 + skipped + 15) % 30
    to_sunday = (F.lit(32) + (century % 4) * 2 + whole(of_century, 4) * 2 - epact - of_century % 4) % 7
    correction = whole(golden + epact * 11 + to_sunday * 22, 451)
    days = epact + to_sunday - correction * 7 + 114
    return F.make_date(year, whole(days, 31).cast("int"), (days % 31 + 1).cast("int"))


def holidays_of_years(years: DataFrame, year: str = "year") -> DataFrame:
    """Holidays of each year in the frame: nine rows per year, one row per date."""
    dated = years.select(F.col(year).cast("int").alias("y")).distinct().withColumn("easter", easter_sunday(F.col("y")))
    dates = [F.make_date("y", F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    dates += [F.date_add("easter", n) for n in EASTER_OFFSETS]
    return dated.select(F.explode(F.array(*dates)).alias("holiday_date"))


def holiday_dim(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    return holidays_of_years(spark.range(first_year, last_year + 1).withColumnRenamed("id", "year"))
