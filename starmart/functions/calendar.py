"""Calendar spine (M8) and date attributes."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.constants import WEEKEND_ISO_DAYS
from starmart.functions.keys import date_key


def _as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def date_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per day in ``[start, end)``, column ``date_day``.

    The bounds are parameters, so the row count is known on the driver
    before any job runs; ``spark.range`` spreads the days over tasks.
    """
    s, e = _as_date(start), _as_date(end)
    days = max((e - s).days, 0)
    return spark.range(days).select(
        F.date_add(F.lit(s), F.col("id").cast("int")).alias("date_day")
    )


def covering_bounds(ts: DataFrame, column: str = "transaction_ts") -> DataFrame:
    """Year-aligned ``[start, end)`` covering every value of ``column``.

    One aggregate row (``start``, ``end``) computed by a partial+final
    min/max: January 1 of the first year and January 1 after the last year.
    """
    d = F.to_date(F.col(column))
    return ts.agg(F.min(d).alias("lo"), F.max(d).alias("hi")).select(
        F.trunc("lo", "year").alias("start"),
        F.add_months(F.trunc("hi", "year"), 12).alias("end"),
    )


def spine_from_bounds(bounds: DataFrame) -> DataFrame:
    """Explode a one-row ``(start, end)`` frame into the days of ``[start, end)``.

    The calendar is bounded by the years of the data (366 rows a year), so
    one task generating it is fine; empty when the data is empty.
    """
    days = F.when(
        F.col("start") < F.col("end"),
        F.sequence(F.col("start"), F.date_sub(F.col("end"), 1), F.expr("INTERVAL 1 DAY")),
    )
    return bounds.select(F.explode(days).alias("date_day"))


def calendar_columns(day: str | Column = "date_day") -> list[Column]:
    """The ten date-dimension columns of a date column."""
    d = F.col(day) if isinstance(day, str) else day
    iso_dow = (F.weekday(d) + 1).cast("int")  # Mon=1 .. Sun=7
    return [
        date_key(d).alias("date_key"),
        d.cast("date").alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_dow.alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        iso_dow.isin(*WEEKEND_ISO_DAYS).alias("is_weekend"),
    ]
