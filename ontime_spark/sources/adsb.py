"""ADS-B flight records (S7): JSON records of the flights API -> table with UTC timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark import schemas as S


def records_to_table(df: DataFrame) -> DataFrame:
    """firstSeen/lastSeen epoch seconds -> timestamps (session time zone UTC)."""
    cols = {c: F.timestamp_seconds(F.col(c)) for c in ("firstSeen", "lastSeen") if c in df.columns}
    return df.withColumns(cols) if cols else df


def parse_json_records(df: DataFrame, col: str = "value") -> DataFrame:
    """A column of JSON objects (one record each) -> typed table."""
    parsed = df.select(F.from_json(F.col(col), S.ADSB_FLIGHT_SCHEMA).alias("r")).select("r.*")
    return records_to_table(parsed)


def read_adsb_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines (or arrays of records with ``multiLine``) with an explicit schema."""
    return records_to_table(spark.read.schema(S.ADSB_FLIGHT_SCHEMA).json(path))
