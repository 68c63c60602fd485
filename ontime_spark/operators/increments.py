"""Encoder and airport-day state that can be added to.

Means cannot be merged, counts and sums can: the state of a set of flights is its label count and
sum per (route, carrier) and per (side, airport, date), kept by month of the flight. Late flights
of a day are added with ``upsert``, which reads and rewrites only the months they belong to
(dynamic partition overwrite); the encoder and the daily rates are derived from the state, whose
size is bounded by routes x carriers x months and airports x dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark import schemas as S
from ontime_spark.operators.encoders import TargetEncoder, TargetEncoderModel
from ontime_spark.operators.models import path_exists
from ontime_spark.session import materialize

#: The partition of flights without a date.
NO_MONTH = "none"
_SUMS = ("n", "s", "ny")


def _month(date_col: str) -> F.Column:
    return F.coalesce(F.date_format(date_col, "yyyy-MM"), F.lit(NO_MONTH)).alias("month_key")


def encoder_state(df: DataFrame, date_col: str = "fl_date", target: str = S.TARGET_COL) -> DataFrame:
    """month_key, route, carrier_key, n, s, ny: rows, label sum and labelled rows of each cell."""
    return TargetEncoder(target=target).cells(df, _month(date_col))


def airport_day_state(df: DataFrame, date_col: str = "fl_date", target: str = S.TARGET_COL) -> DataFrame:
    """month_key, side, airport, date, n, s, ny for both ends of the flights, in one pass."""
    y = F.col(target).cast("double")
    ends = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("airport")) for side in ("origin", "dest")])
    rows = df.select(_month(date_col), F.col(date_col).alias("date"), y.alias("y"), F.inline(ends))
    return (rows.where(F.col("airport").isNotNull() & F.col("date").isNotNull()).groupBy("month_key", "side", "airport", "date")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.count("y").alias("ny")))


def merged(*states: DataFrame) -> DataFrame:
    """One state from several of the same kind."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    keys = [c for c in out.columns if c not in _SUMS]
    return out.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def upsert(spark: SparkSession, state: DataFrame, path: str) -> str:
    """Add ``state`` to the one saved under ``path``: months without new flights are not read."""
    state = materialize(state, "state-part")
    if path_exists(spark, path):
        months = [r[0] for r in state.select("month_key").distinct().collect()]  # bounded by the calendar
        old = spark.read.parquet(path).withColumn("month_key", F.col("month_key").cast("string"))
        # Written apart first: a month cannot be read and overwritten in one job.
        state = materialize(merged(old.where(F.col("month_key").isin(months)), state), "state-merged")
    (state.repartition("month_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("month_key").parquet(path))
    return path


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def encoder_of(state: DataFrame, smoothing: int = S.SMOOTHING) -> TargetEncoderModel:
    """The target encoder fitted on all flights of the state."""
    return TargetEncoder(smoothing=smoothing).fit_cells(state)


def daily_rates(state: DataFrame, side: str, date_col: str = "fl_date") -> DataFrame:
    """A2 from the state: mean label per (airport, date) of one side."""
    per = merged(state.where(F.col("side") == side).select("airport", "date", *_SUMS))
    return per.select(F.col("airport").alias(side), F.col("date").alias(date_col), F.try_divide("s", F.col("ny").cast("double")).alias("daily_rate"))
