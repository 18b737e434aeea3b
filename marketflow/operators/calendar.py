"""Day and month calendars generated inside Spark, and calendar gaps.

A calendar is as long as its date range, not as the data: it is generated
from a one-row aggregate with ``sequence`` + ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_calendar(bounds: DataFrame, start: str | Column, end: str | Column,
                 name: str = "day") -> DataFrame:
    """Every day from ``start`` to ``end`` (both included), for each row of
    ``bounds`` (usually a one-row aggregate); none when ``start`` is later."""
    first, last = _c(start).cast("date"), _c(end).cast("date")
    seq = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    return bounds.select(F.explode(seq).alias(name))


def request_days(spark, start, end=None, name: str = "day",
                 base_path: str | None = None) -> DataFrame:
    """Days to request from a daily API: ``start`` through ``end``, by
    default yesterday (today's bars are not final yet); none when the caller
    is up to date. With ``base_path``, also the per-day request path ``<base>/<yyyy-MM-dd>``."""
    from marketflow.functions.dates import as_date_value, day_text
    last = as_date_value(end) if end is not None else F.date_sub(F.current_date(), 1)
    bounds = spark.range(1).select(as_date_value(start).alias("s"), last.alias("e"))
    days = day_calendar(bounds, "s", "e", name)
    if base_path is not None:
        days = days.withColumn("path", F.concat(F.lit(base_path.rstrip("/") + "/"), day_text(name)))
    return days


def month_calendar(bounds: DataFrame, start: str | Column, end: str | Column,
                   base_path: str | None = None) -> DataFrame:
    """Every month touched by ``start``..``end`` (any day of the month, across
    year ends) as ``year, month`` and, with ``base_path``, the partition path
    ``<base>/year=Y/month=M``."""
    first = F.trunc(_c(start).cast("date"), "MM")
    last = F.trunc(_c(end).cast("date"), "MM")
    seq = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    months = bounds.select(F.explode(seq).alias("m"))
    out = months.select(F.year("m").alias("year"), F.month("m").alias("month"))
    if base_path is not None:
        out = out.withColumn("path", F.concat(
            F.lit(base_path.rstrip("/") + "/year="), F.col("year").cast("string"),
            F.lit("/month="), F.col("month").cast("string")))
    return out


def calendar_gaps(calendar: DataFrame, dates: DataFrame, day_col: str = "day",
                  date_col: str = "day") -> DataFrame:
    """Calendar days with no row in ``dates`` (left-anti join on the day).

    The data side is reduced to its distinct days first, so the join input
    is as small as the calendar."""
    seen = dates.select(F.col(date_col).alias("_seen")).distinct()
    return calendar.join(seen, calendar[day_col] == seen["_seen"], "left_anti")
