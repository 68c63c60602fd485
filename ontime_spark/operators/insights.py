"""Historical insight aggregations.

The dashboard rates are computed on raw rows: cancelled flights are included, a missing delay
counts as on time and the hour is HHMM // 100 without clipping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark import schemas as S


def _delayed(threshold: float) -> F.Column:
    return F.coalesce(F.col("arr_delay") >= threshold, F.lit(False)).cast("double")


def delay_rate_by_hour(df: DataFrame, threshold: float = S.DELAY_THRESHOLD_MINUTES) -> DataFrame:
    """Delay rate (%) per scheduled hour."""
    hour = F.floor(F.col("crs_dep_time") / 100).cast("int")
    return (df.groupBy(hour.alias("hour"))
              .agg((F.avg(_delayed(threshold)) * 100).alias("delay_rate_pct")))


def delay_rate_by_carrier(df: DataFrame, threshold: float = S.DELAY_THRESHOLD_MINUTES) -> DataFrame:
    """Delay rate (%) per carrier, highest first."""
    return (df.groupBy("carrier")
              .agg((F.avg(_delayed(threshold)) * 100).alias("delay_rate_pct"))
              .orderBy(F.desc("delay_rate_pct"), "carrier"))


def airport_months(df: DataFrame, airport_col: str = "origin",
                   date_col: str = "fl_date") -> DataFrame:
    """A10: distinct (airport, year, month) with their row counts."""
    d = F.col(date_col).try_cast("date")
    return (df.where(F.col(airport_col).isNotNull() & d.isNotNull())
              .groupBy(F.col(airport_col).alias("airport"), F.year(d).alias("year"),
                       F.month(d).alias("month"))
              .agg(F.count(F.lit(1)).alias("n_flights")))


def distinct_airports(df: DataFrame, airport_col: str = "origin") -> DataFrame:
    """A10: number of distinct airports (exact; map-side distinct before the shuffle)."""
    return df.agg(F.count_distinct(airport_col).alias("n_airports"))
