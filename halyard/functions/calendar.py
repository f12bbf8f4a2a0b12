"""Date keys, durations and the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an int; null stays null."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def _seconds(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(_col(end).cast("timestamp")) - F.unix_timestamp(_col(start).cast("timestamp"))


def los_hours(admission: Column | str, discharge: Column | str) -> Column:
    """Hours of a stay as decimal(10,2); null while it is open."""
    return (_seconds(admission, discharge).cast("decimal(18,2)") / 3600).cast("decimal(10,2)")


def turnaround_minutes(ordered: Column | str, result: Column | str) -> Column:
    """Whole minutes from order to result, towards zero."""
    return F.timestamp_diff("MINUTE", _col(ordered).cast("timestamp"), _col(result).cast("timestamp")).cast("int")


def date_dimension(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row a day, both ends included. Days of the week count from Sunday = 1, weeks are ISO weeks."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )
