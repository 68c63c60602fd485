"""Flight files: load by suffix (S1) and write partitioned by year/month."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.session import wide_session


def load_flights(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """``.csv`` (header; the canonical columns typed, blanks null) or ``.parquet``/``.pq``; any
    other suffix is an error unless ``fmt`` names the format (e.g. for a directory)."""
    kind = fmt or {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}.get(
        os.path.splitext(path.rstrip("/"))[1].lower())
    if kind == "csv":
        from ontime_spark.operators.clean import cast_types
        return cast_types(wide_session(spark).read.option("header", True).csv(path))
    if kind == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"cannot tell how to read {path}: the suffix is neither csv nor parquet")


def write_flights(df: DataFrame, path: str, date_col: str = "fl_date",
                  partitions: int | None = None) -> None:
    """Range-partition on the date (each task writes a contiguous date range, so each
    year/month folder gets few files), sort within partitions, write Parquet partitioned by
    year and month (later month filters prune folders).

    A row hash is the range key's second component: a range partitioner cannot split equal
    keys, so a date holding a large share of the rows is spread over several tasks instead
    of one."""
    d = F.col(date_col)
    out = df.withColumns({"year": F.year(d), "month": F.month(d),
                          "_spread": F.xxhash64(*[F.col(c) for c in df.columns])})
    keys = [date_col, "_spread"]
    out = (out.repartitionByRange(partitions, *keys) if partitions
           else out.repartitionByRange(*keys))
    (out.sortWithinPartitions(date_col).drop("_spread")
        .write.mode("overwrite").partitionBy("year", "month").parquet(path))
