"""Casts, time text and name helpers. Every one is a built-in expression."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed formats.
DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
DAY_NUMBER = "yyyyMMdd"
MONEY = "decimal(16,2)"
# wide enough for a sum of sums
TOTAL = "decimal(26,2)"
DAY_MS = 24 * 60 * 60 * 1000


def money(c) -> Column:
    """Amount text to decimal(16,2); text that is no number gives null."""
    return F.col(c).try_cast(MONEY) if isinstance(c, str) else c.try_cast(MONEY)


def amount_or_zero(c) -> Column:
    return F.coalesce(money(c), F.lit(0).cast(MONEY))


def times(quantity: Column, price: Column) -> Column:
    """Quantity times price in decimals, rounded to cents."""
    return (money(quantity) * money(price)).cast(MONEY)


def whole(c: Column) -> Column:
    return c.try_cast("int")


def choose(condition: Column, yes: Column, no: Column) -> Column:
    return F.when(condition, yes).otherwise(no)


def text_time(c: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` or `yyyy-MM-dd` text to a timestamp in the session zone."""
    return F.coalesce(F.try_to_timestamp(c, F.lit(DATE_TIME)), F.try_to_timestamp(c, F.lit(DATE)))


def text_ms(c: Column) -> Column:
    return F.unix_millis(text_time(c))


def ms_time(c: Column) -> Column:
    return F.timestamp_millis(c)


def ms_date_text(c: Column) -> Column:
    return F.date_format(F.timestamp_millis(c), DATE)


def ms_date_time_text(c: Column) -> Column:
    return F.date_format(F.timestamp_millis(c), DATE_TIME)


def date_text(c: Column) -> Column:
    """The day of a date-time text, as text."""
    return F.date_format(text_time(c), DATE)


def date_part(c: Column) -> Column:
    """The day of a date-time text, as a date."""
    return F.to_date(text_time(c))


def day_number(c: Column) -> Column:
    return F.date_format(c, DAY_NUMBER)


def zoned_ms(c: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss.fZ` with one to three fraction digits to epoch ms.

    A missing digit is a trailing zero, so `.9Z` is 900 ms.
    """
    return F.unix_millis(c.try_cast("timestamp"))


def emission_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def camel(name: str) -> str:
    head, *rest = re.split("_+", name.strip("_"))
    return head.lower() + "".join(p[:1].upper() + p[1:].lower() for p in rest)


def rename_columns(df: DataFrame) -> DataFrame:
    """snake_case column names to camelCase."""
    return df.toDF(*[camel(c) for c in df.columns])
