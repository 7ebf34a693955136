"""Calendar (date dimension) generator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference flags dayofweek 6 and 7 (Friday, Saturday with
# Sunday = 1) as weekend; kept as the default and exposed as a parameter.
WEEKEND_DAYS = (6, 7)

DIM_DATE_COLUMNS = ["date_key", "full_date", "year", "quarter", "month", "day", "day_name", "is_weekend"]


def _dim_from_dates(dates: DataFrame, weekend_days: Sequence[int]) -> DataFrame:
    d = F.col("full_date")
    return dates.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("date_key"),
        d.alias("full_date"), F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(list(weekend_days)).alias("is_weekend"))


def dim_date(spark: SparkSession, start: str, end: str,
             weekend_days: Sequence[int] = WEEKEND_DAYS) -> DataFrame:
    """Every date in ``[start, end]`` with its calendar attributes."""
    seq = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    return _dim_from_dates(spark.range(1).select(F.explode(seq).alias("full_date")), weekend_days)


def dim_date_covering(df: DataFrame, ts: str | Column,
                      weekend_days: Sequence[int] = WEEKEND_DAYS) -> DataFrame:
    """Calendar spanning ``min(ts)``…``max(ts)`` of ``df``, computed in-plan.

    The bounds are a one-row aggregate; the calendar has one row per day, so
    its size is bounded by the date span, not by the data volume.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    bounds = df.agg(F.min(F.to_date(t)).alias("lo"), F.max(F.to_date(t)).alias("hi"))
    dates = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return _dim_from_dates(dates, weekend_days)
