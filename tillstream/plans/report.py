"""The sales report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.scalars import TOTAL
from tillstream.sources.sinks import DAY


def _day(date: int) -> Column:
    return F.to_date(F.lit(str(date)), "yyyyMMdd") if date else F.current_date()


def of_day(df: DataFrame, text: str, date: int = 0) -> DataFrame:
    """Rows whose date-time text is of a day given as yyyyMMdd; 0 is today.

    A range of texts, so it can be pushed down to files.
    """
    first, after = (F.concat(d.cast("string"), F.lit(" 00:00:00")) for d in (_day(date), F.date_add(_day(date), 1)))
    return df.filter((F.col(text) >= first) & (F.col(text) < after))


def gmv(windows: DataFrame, date: int = 0) -> DataFrame:
    """Total order amount of a day given as yyyyMMdd; 0 is today. Null where no rows are.

    The day is a range of `stt` texts, so it can be pushed down to the window table's files. Files
    in folders by day, as sinks.window_batch writes them, are only opened for that day.
    """
    if DAY in windows.columns:
        windows = windows.filter(F.col(DAY) == _day(date))
    return of_day(windows, "stt", date).agg(F.sum(F.col("order_amount").cast(TOTAL)).cast("double").alias("order_amount"))
