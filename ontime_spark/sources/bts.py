"""BTS On-Time Performance CSV files (S2, S3) and their mapping to canonical columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ontime_spark import schemas as S
from ontime_spark.operators.encoders import resolve_carrier_col

PHANTOM = re.compile(r"^_c\d+$")


def clean_bts(raw: DataFrame) -> DataFrame:
    """Drop the unnamed column a trailing comma creates, trim text, cast the known columns
    by name (unparsable values and NaN become null; unknown columns stay text)."""
    cols = [c for c in raw.columns if not PHANTOM.match(c)]
    out = []
    for c in cols:
        v = F.trim(F.col(f"`{c}`"))
        t = S.BTS_TYPES.get(c)
        if t is None or isinstance(t, T.StringType):
            out.append(v.alias(c))
        elif isinstance(t, (T.ShortType, T.ByteType)):
            # Integer columns may be written as "5.00": parse as a number, then narrow.
            out.append(v.try_cast("double").try_cast(t).alias(c))
        else:
            out.append(F.nanvl(v.try_cast(t), F.lit(None).cast(t)).alias(c))  # the text "NaN" is no number
    return raw.select(*out)


def load_bts_csv(spark: SparkSession, path: str) -> DataFrame:
    """One (or a glob of) BTS CSV file(s). Read as text with the header, never with
    DROPMALFORMED (with a schema that mode drops every row of a trailing-comma file)."""
    try:
        raw = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no BTS file at {path}") from e
    return clean_bts(raw)


def _files_by_header(spark: SparkSession, pattern: str) -> dict[str, list[str]]:
    """Paths that match a glob pattern, by their first line. One line of each file is read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[str, list[str]] = {}
    for status in fs.globStatus(path) or ():
        stream = fs.open(status.getPath())
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            header = reader.readLine() or ""
        finally:
            stream.close()
        out.setdefault(header, []).append(status.getPath().toString())
    return out


def load_all_bts(spark: SparkSession, directory: str, year: int | None = None) -> DataFrame:
    """Every ``*.csv`` (or ``*{year}*.csv``) of a directory; ``source_file`` keeps the
    file name.

    Monthly files may differ in the order and number of their columns: files of one header are
    one distributed read, and the reads are united by column name (absent columns are null).
    Empty files have no rows and no columns."""
    pattern = f"{directory.rstrip('/')}/*{year}*.csv" if year else f"{directory.rstrip('/')}/*.csv"
    out: DataFrame | None = None
    for header, paths in sorted(_files_by_header(spark, pattern).items()):
        if not header:
            continue
        raw = spark.read.option("header", True).csv(paths).withColumn("source_file", F.col("_metadata.file_name"))
        part = clean_bts(raw)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no BTS files match {pattern}")
    return out


# BTS name -> canonical name (the carrier is resolved separately).
BTS_TO_CANONICAL = {
    "FlightDate": "fl_date", "Origin": "origin", "Dest": "dest", "CRSDepTime": "crs_dep_time",
    "ArrDelay": "arr_delay", "Cancelled": "cancelled", "Distance": "distance",
}


def bts_to_canonical(df: DataFrame, keep_other: bool = False) -> DataFrame:
    """Rename and type the BTS fields as the canonical flight columns; the carrier is the
    first present of Reporting_Airline, carrier, Marketing_Airline_Network,
    IATA_CODE_Reporting_Airline (error if none)."""
    carrier = resolve_carrier_col(df)
    sel = [F.col(carrier).cast("string").alias("carrier")]
    types = {"fl_date": "date", "origin": "string", "dest": "string", "crs_dep_time": "int",
             "arr_delay": "double", "cancelled": "int", "distance": "double"}
    for src, dst in BTS_TO_CANONICAL.items():
        if src in df.columns:
            text = types[dst] == "int" and isinstance(df.schema[src].dataType, T.StringType)
            v = F.col(src).try_cast("double") if text else F.col(src)
            sel.append(v.try_cast(types[dst]).alias(dst))
    if keep_other:
        used = set(BTS_TO_CANONICAL) | {carrier}
        sel += [F.col(c) for c in df.columns if c not in used]
    return df.select(*sel)
