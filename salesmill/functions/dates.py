"""Calendar expressions over 8-digit integer dates (yyyyMMdd)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def int_date(c: str | Column) -> Column:
    """Date or timestamp -> yyyyMMdd integer."""
    c = col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.day(c)).cast("int")


def int_to_date(c: str | Column) -> Column:
    """yyyyMMdd integer -> date; NULL for anything that is not a calendar day."""
    return F.try_to_timestamp(col(c).cast("string"), F.lit("yyyyMMdd")).cast("date")


def as_int(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def int_year(c: str | Column) -> Column:
    return F.floor(col(c) / 10000).cast("int")


def int_month(c: str | Column) -> Column:
    return (F.floor(col(c) / 100) % 100).cast("int")


def year_month(c: str | Column) -> Column:
    """yyyyMMdd integer -> yyyyMM integer."""
    return F.floor(col(c) / 100).cast("int")


def fiscal_year(c: str | Column, start_month: int = 4) -> Column:
    """Year in which the fiscal year of the given int date began."""
    return F.when(int_month(c) >= start_month, int_year(c)).otherwise(int_year(c) - 1).cast("int")


def fiscal_quarter(c: str | Column, start_month: int = 4) -> Column:
    """Q1..Q4 of the fiscal year."""
    quarter = F.floor(F.pmod(int_month(c) - start_month, F.lit(12)) / 3) + 1
    return F.concat(F.lit("Q"), quarter.cast("string"))


def days_since(c: str | Column, as_of: dt.date) -> Column:
    """Days between an int date and a given day (a parameter, so reruns agree)."""
    return F.datediff(F.lit(as_of), int_to_date(c))
