"""Dates: forgiving parsing, calendar attributes, compact forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "EEE, dd MMM yyyy HH:mm:ss Z"]
#: key of dates that can't be read
UNKNOWN_KEY = 19000101


def parse_date(c: Column) -> Column:
    """The first format that fits, else null."""
    t = F.trim(c.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in FORMATS[:-1]], F.try_to_timestamp(t)).cast("date")


def date_key(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "yyyyMMdd").cast("int"), F.lit(UNKNOWN_KEY))


def ddmmyy(c: Column) -> Column:
    return F.coalesce(F.date_format(parse_date(c), "ddMMyy"), F.lit("000000"))


def calendar(d: Column) -> list[Column]:
    """Columns of Dim_Time for a date."""
    return [
        date_key(d).alias("Date_Key"),
        F.year(d).alias("Year"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("Quarter"),
        F.date_format(d, "MMMM").alias("Month"),
        F.month(d).alias("Month_Number"),
        F.dayofmonth(d).alias("Day"),
        F.date_format(d, "EEEE").alias("Day_of_Week"),
        F.weekofyear(d).alias("Week_of_Year"),
        F.date_format(d, "yyyy-MM-dd").alias("Date_String"),
    ]
