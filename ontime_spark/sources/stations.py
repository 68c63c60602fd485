"""Station inventory (S5): the ISD station history CSV with the three ids kept as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ontime_spark import schemas as S


def read_station_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with the fixed column set; USAF, WBAN and ICAO stay strings (leading
    zeros kept), coordinates and elevation are doubles (blank -> null)."""
    return (spark.read.option("header", True).option("quote", '"')
            .schema(S.STATION_SCHEMA).csv(path))
