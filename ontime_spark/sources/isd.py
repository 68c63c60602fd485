"""NOAA ISD hourly observations.

Files are ``{USAF}-{WBAN}-{YEAR}.gz`` fixed-width text. ``spark.read.text`` decompresses gzip
natively (one task per file, since gzip does not split); a year of hourly lines per station is
a few MB, so thousands of station-years give thousands of tasks without a repartition. Each
line becomes one observation with built-in substring/try_cast expressions: no Python parser.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.functions import weather as WF

NUMERIC_FIELDS = ("wind_speed", "ceiling", "visibility", "temp", "dew_point")
# Fields stored in tenths.
SCALED = {"wind_speed": 10.0, "temp": 10.0, "dew_point": 10.0}
FILE_NAME = r"(\d{6})-(\d{5})-(\d{4})\.gz$"


def parse_isd_lines(lines: DataFrame, line_col: str = "line", layout: str = "public",
                    keep: Sequence[str] = ()) -> DataFrame:
    """C14: parse the mandatory section of each line.

    A line shorter than 105 characters, with a field that is neither a number nor blank/a
    missing sentinel, or with an invalid date/time is dropped. Sentinels become null; wind,
    temperature and dew point are divided by 10. Gust, precipitation and present weather are
    not in the mandatory section and stay null.

    Two projections: the trimmed text of each field first, then numbers and the validity test
    over those columns, so every slice is cut once (a single nested expression per field
    would repeat the substring chain and exceed the 64 KB code-generation limit).
    """
    line = F.col(line_col)
    raw = lines.where(F.length(line) >= WF.ISD_MIN_LENGTH).select(
        *keep,
        WF.isd_slice(line, "usaf", layout).alias("usaf"),
        WF.isd_slice(line, "wban", layout).alias("wban"),
        WF.isd_timestamp(line, layout).alias("timestamp"),
        *[WF.isd_raw(line, f, layout).alias(f"_r_{f}") for f in NUMERIC_FIELDS])
    nums = raw.select(*keep, "usaf", "wban", "timestamp", *[
        F.col(f"_r_{f}").alias(f"_r_{f}") for f in NUMERIC_FIELDS], *[
        F.col(f"_r_{f}").try_cast("double").alias(f"_n_{f}") for f in NUMERIC_FIELDS])
    ok = F.col("timestamp").isNotNull()
    for f in NUMERIC_FIELDS:
        ok = ok & (F.col(f"_r_{f}").isNull() | F.col(f"_n_{f}").isNotNull())

    def num(f: str) -> F.Column:
        v = F.col(f"_n_{f}")
        return v / SCALED[f] if f in SCALED else v

    return nums.where(ok).select(
        *keep, "usaf", "wban", "timestamp",
        num("temp").alias("temp_c"),
        num("dew_point").alias("dew_point_c"),
        num("wind_speed").alias("wind_speed_ms"),
        F.lit(None).cast("double").alias("wind_gust_ms"),
        num("visibility").alias("visibility_m"),
        num("ceiling").alias("ceiling_m"),
        F.lit(None).cast("double").alias("precip_mm"),
        F.lit(None).cast("string").alias("present_weather"),
    )


def read_isd(spark: SparkSession, paths: str | Sequence[str], layout: str = "public",
             repartition: int | None = None) -> DataFrame:
    """Read ISD files (plain or gzip) into observations with ``station_id`` and ``year``
    taken from the file name."""
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths))
    raw = raw.select(F.col("value").alias("line"),
                     F.col("_metadata.file_name").alias("_file"))
    if repartition:
        raw = raw.repartition(repartition)
    obs = parse_isd_lines(raw, layout=layout, keep=["_file"])
    from_name = F.regexp_extract("_file", FILE_NAME, 1) != ""
    return obs.select(
        F.when(from_name, F.concat_ws("-", F.regexp_extract("_file", FILE_NAME, 1),
                                      F.regexp_extract("_file", FILE_NAME, 2)))
         .otherwise(F.concat_ws("-", "usaf", "wban")).alias("station_id"),
        F.when(from_name, F.regexp_extract("_file", FILE_NAME, 3).try_cast("int"))
         .otherwise(F.year("timestamp")).alias("file_year"),
        *[c for c in obs.columns if c != "_file"])


def filter_month(obs: DataFrame, month: int, ts_col: str = "timestamp") -> DataFrame:
    """Observations of one calendar month."""
    return obs.where(F.month(ts_col) == month)
