"""Calendar dimensions, one row a day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.dates import date_key, day_name, iso_weekday, month_name


def days_from(spark: SparkSession, start: str | date, days: int) -> DataFrame:
    """`days` consecutive days from `start`."""
    return spark.range(days).select(F.date_add(F.lit(str(start)).cast("date"), F.col("id").cast("int")).alias("date_actual"))


def days_between(bounds: DataFrame, low: str, high: str) -> DataFrame:
    """Every day from the earliest `low` to the latest `high` of the rows."""
    return bounds.agg(F.min(F.to_date(low)).alias("lo"), F.max(F.to_date(high)).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_actual"))


def describe_days(days: DataFrame, locale: str = "ru") -> DataFrame:
    """CAL-1: the 25 columns of the full calendar for a frame of days."""
    d = F.col("date_actual")
    weekday, month = iso_weekday(d), F.month(d)
    quarter_start = F.trunc(d, "quarter")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    year = F.year(d).cast("string")
    return days.select(
        date_key(d).alias("date_pk"), d,
        day_name(d, locale).alias("day_name"), weekday.alias("day_of_week"), F.dayofmonth(d).alias("day_of_month"),
        (F.datediff(d, quarter_start) + 1).alias("day_of_quarter"), F.dayofyear(d).alias("day_of_year"),
        F.ceil(F.dayofmonth(d) / 7).cast("int").alias("week_of_month"), F.weekofyear(d).alias("week_of_year"),
        month.alias("month_actual"), month_name(d, locale).alias("month_name"),
        F.substring(month_name(d, "en"), 1, 3).alias("month_name_abbreviated"),
        F.quarter(d).alias("quarter_actual"), F.year(d).alias("year_actual"),
        F.date_sub(d, weekday - 1).alias("first_day_of_week"), F.date_add(d, 7 - weekday).alias("last_day_of_week"),
        F.trunc(d, "month").alias("first_day_of_month"), F.last_day(d).alias("last_day_of_month"),
        quarter_start.alias("first_day_of_quarter"),
        F.date_sub(F.add_months(quarter_start, 3), 1).alias("last_day_of_quarter"),
        F.make_date(F.year(d), F.lit(1), F.lit(1)).alias("first_day_of_year"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("last_day_of_year"),
        F.concat(two(month), year).alias("mmyyyy"),
        F.concat(two(month), two(F.dayofmonth(d)), year).alias("mmddyyyy"), (weekday >= 6).alias("weekend_indr"))


def describe_days_short(days: DataFrame, locale: str = "ru") -> DataFrame:
    """CAL-2: the five columns of the short calendar."""
    d = F.col("date_actual")
    return days.select(date_key(d).alias("date_id"), d, F.dayofmonth(d).alias("day_of_month"),
                       month_name(d, locale).alias("month_name"), F.year(d).alias("year"))


def calendar(spark: SparkSession, start: str | date, days: int, locale: str = "ru") -> DataFrame:
    return describe_days(days_from(spark, start, days), locale)


def calendar_short(spark: SparkSession, start: str | date, days: int, locale: str = "ru") -> DataFrame:
    return describe_days_short(days_from(spark, start, days), locale)
