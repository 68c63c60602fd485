"""Cleaning: type casts (P1), cancelled filter (P2), delay label (P3), missing-value fill (P4),
missing-value profile (A6), table profile (A11) and the chained preprocess step (L1)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark import schemas as S
from ontime_spark.operators.cumulative import approx_medians, exact_medians

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def parsed_number(c: str, target: T.DataType) -> F.Column:
    """Text as a number of ``target``: read as a double first, so that "1200.0" is a valid
    integer; NaN and unparsable text are null."""
    d = present(F.col(c).try_cast("double"))
    return d if isinstance(target, T.DoubleType) else d.try_cast(target)


def present(c: str | F.Column) -> F.Column:
    """A number, with NaN as the missing value it stands for in files."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Floating columns (``columns``, all by default) with null for NaN."""
    floats = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    changes = {c: F.nanvl(F.col(c), F.lit(None).cast(t)) for c, t in floats.items() if columns is None or c in columns}
    return df.withColumns(changes) if changes else df


def cast_types(df: DataFrame) -> DataFrame:
    """Every canonical column to its type: carrier/origin/dest to string, fl_date to date,
    numbers and flags to their canonical type. Unparsable values become null (``try_cast``:
    ANSI mode would otherwise fail), NaN too. Columns of other names keep their type."""
    present = {f.name: f.dataType for f in df.schema.fields}
    changes = {}
    for c in S.STRING_COLUMNS:
        if c in present:
            changes[c] = F.col(c).cast("string")
    for f in S.FLIGHTS_SCHEMA.fields:
        if f.name not in present or f.name in changes:
            continue
        if isinstance(f.dataType, T.DateType):
            changes[f.name] = F.col(f.name).try_cast("date")
        elif isinstance(f.dataType, _NUMERIC):
            text = isinstance(present[f.name], T.StringType)
            if text or f.name in S.NUMERIC_CANDIDATES:
                changes[f.name] = parsed_number(f.name, f.dataType) if text else F.col(f.name).try_cast(f.dataType)
    return nan_to_null(df.withColumns(changes) if changes else df)


def _kept() -> F.Column:
    # Text that is no number counts as a missing value.
    return F.coalesce(F.col("cancelled").try_cast("double") == 0, F.lit(False))


def filter_cancelled(df: DataFrame) -> DataFrame:
    """Keep rows whose ``cancelled`` is 0; a missing value counts as cancelled."""
    if "cancelled" not in df.columns:
        return df
    return df.where(_kept())


def cancelled_counts(df: DataFrame) -> DataFrame:
    """P2's log line as data: one row (n_before, n_removed, pct_removed), one pass.

    (``DataFrame.observe`` would avoid the pass, but in Spark 4.1 a session that has used an
    ``Observation`` can no longer serialize Spark ML model transforms.)"""
    n = F.count(F.lit(1))
    removed = F.count_if(~_kept())
    return df.agg(n.alias("n_before"), removed.alias("n_removed"),
                  (100 * removed / F.greatest(n, F.lit(1))).alias("pct_removed"))


def add_delay_label(df: DataFrame, threshold: float = S.DELAY_THRESHOLD_MINUTES) -> DataFrame:
    """``is_delayed`` = arr_delay >= threshold; a missing delay (null or NaN) is labelled 0."""
    if "arr_delay" not in df.columns:
        raise KeyError("no arr_delay column to label delays from")
    return df.withColumn(
        S.TARGET_COL, F.coalesce(present("arr_delay") >= threshold, F.lit(False)).cast("int"))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values (null or NaN) per column as one row (one pass, map-side combined)."""
    cols = list(columns) if columns is not None else df.columns
    df = nan_to_null(df, cols)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def column_medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict[str, float]:
    """Medians of numeric columns as a small dict (one value per column).

    ``exact`` uses the distributed running-total selection; otherwise a quantile sketch."""
    if not columns:
        return {}
    med = exact_medians(df, columns) if exact else approx_medians(df, columns)
    return {r["name"]: r["median"] for r in med.collect()}


class MissingValueFiller:
    """P4 as an estimator: ``fit`` learns per-column medians (numeric columns that have nulls)
    and the string columns to fill with 'UNKNOWN'; ``transform`` is a ``fillna``."""

    def __init__(self, exact: bool = True, unknown: str = "UNKNOWN"):
        self.exact = exact
        self.unknown = unknown
        self.medians: dict[str, float] = {}
        self.string_cols: list[str] = []

    def fit(self, df: DataFrame, null_counts: dict[str, int] | None = None) -> "MissingValueFiller":
        """``null_counts`` (per numeric column) skips the counting pass when the caller already
        has them, e.g. observed while the table was written."""
        num = numeric_columns(df)
        if null_counts is not None:
            counts = null_counts
        else:
            counts = missing_counts(df, num).first().asDict() if num else {}
        with_nulls = [c for c in num if counts.get(c, 0) > 0]
        self.medians = column_medians(df, with_nulls, self.exact)
        self.string_cols = string_columns(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}
        fills = {}
        for c, m in self.medians.items():
            if c in types and m is not None:
                # A column with missing values is floating point (as a pandas column with NaN).
                fills[c] = F.coalesce(present(c), F.lit(float(m)))
        for c in self.string_cols:
            if c in types:
                fills[c] = F.coalesce(F.col(c), F.lit(self.unknown))
        return df.withColumns(fills) if fills else df

    def save(self, spark: SparkSession, path: str) -> None:
        """The learned medians and text columns as one JSON line under ``path``."""
        state = {"exact": self.exact, "unknown": self.unknown, "medians": self.medians,
                 "string_cols": self.string_cols}
        (spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1)
              .write.mode("overwrite").text(path))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "MissingValueFiller":
        state = json.loads(spark.read.text(path).first()[0])
        out = cls(state["exact"], state["unknown"])
        out.medians, out.string_cols = state["medians"], state["string_cols"]
        return out


def fill_missing(df: DataFrame, exact: bool = True, materialize: bool = False) -> DataFrame:
    """Numeric nulls -> column median, string nulls -> 'UNKNOWN'. ``materialize`` writes the
    table once to the shared checkpoint folder, so that the passes for the counts, the medians and the fill
    read it instead of recomputing the input's joins."""
    if materialize:
        from ontime_spark.session import materialize as _materialize
        df = _materialize(df, "unfilled")
    return MissingValueFiller(exact=exact).fit(df).transform(df)


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None,
                    exact: bool = True) -> DataFrame:
    """One row per numeric column: (column, n_missing, median). Null counts are one
    aggregation; see ``exact_medians`` for the medians."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    counts = missing_counts(df, cols)
    nulls = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("n_missing"))
        for c in cols])))
    med = exact_medians(df, cols) if exact else approx_medians(df, cols)
    med = med.select(F.col("name").alias("column"), "median")
    return (names.join(nulls, "column", "left").fillna(0, ["n_missing"])
                 .join(med, "column", "left"))


def profile(df: DataFrame, date_col: str = "fl_date") -> DataFrame:
    """Row count, column count and date range in one aggregation."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols")]
    if date_col in df.columns:
        aggs += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    return df.agg(*aggs)


def preprocess(df: DataFrame, threshold: float = S.DELAY_THRESHOLD_MINUTES,
               exact_median: bool = True, materialize: bool = False) -> DataFrame:
    """L1: cast -> drop cancelled -> label -> fill missing (label before fill, as published).

    Filling needs statistics of the labelled table (null counts, medians) before the fill
    itself, i.e. several passes. ``materialize`` writes the labelled table once to the shared
    checkpoint folder so those passes (and every later one) read it instead of recomputing
    the input's joins."""
    df = cast_types(df)
    df = filter_cancelled(df)
    df = add_delay_label(df, threshold)
    if materialize:
        from ontime_spark.session import materialize as _materialize
        df = _materialize(df, "labelled")
    return MissingValueFiller(exact=exact_median).fit(df).transform(df)


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str], date_col: str = "fl_date") -> DataFrame:
    """A11 and the null counts of A6 for Parquet files, from their footers: n_rows, min_date, max_date and
    ``{column}_missing``. The aggregates are pushed into the reader, so no column is read; a file
    without statistics of a column is scanned for it alone. (NaN is a value to a file's statistics:
    tables are written after the casts, which leave none.)

    Only the newer file reader pushes aggregates down: a session of its own has it switched on, the
    caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(path)
    found = df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                   *[F.count(c).alias(c) for c in columns])
    return found.select("n_rows", "min_date", "max_date", *[(F.col("n_rows") - F.col(c)).alias(f"{c}_missing") for c in columns])
