"""Leakage-safe feature estimator (L7) and the model-matrix steps around it: column-name twins
(P6), feature alignment (P9), X/y assembly (P10), numeric subset (P11), temporal split (P12)
and scoring-input defaults (P15)."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark import schemas as S
from ontime_spark.operators import features as FE
from ontime_spark.operators.encoders import TargetEncoder, TargetEncoderModel

# CamelCase twins added next to the canonical names (canonical -> twin).
CASING = {
    "fl_date": "FlightDate", "crs_dep_time": "CRSDepTime", "origin": "Origin", "dest": "Dest",
    "distance": "Distance", "cancelled": "Cancelled",
}


def map_casing(df: DataFrame) -> DataFrame:
    """Add the CamelCase twin of each canonical column that has none.

    Spark resolves column names case-insensitively, so ``Origin``, ``Dest``, ``Distance`` and
    ``Cancelled`` already address the canonical columns (adding them would replace the
    originals); only twins whose names differ beyond case (``FlightDate``, ``CRSDepTime``)
    are added."""
    present = {c.lower() for c in df.columns}
    twins = {new: F.col(old) for old, new in CASING.items()
             if old in df.columns and new.lower() not in present}
    return df.withColumns(twins) if twins else df


def align_features(df: DataFrame, target: str = S.TARGET_COL,
                   keep: Sequence[str] = ()) -> DataFrame:
    """The 39 features in canonical order (absent -> 0), the target first when present,
    plus any ``keep`` columns (e.g. row keys) in front."""
    cols = [F.col(c) for c in keep]
    if target in df.columns:
        cols.append(F.col(target))
    cols += [F.col(c) if c in df.columns else F.lit(0).alias(c) for c in S.FEATURE_COLUMNS]
    return df.select(*cols)


def numeric_matrix(df: DataFrame, keep: Sequence[str] = (), target: str = S.TARGET_COL) -> DataFrame:
    """The 36 numeric features with nulls set to 0 (plus the target and ``keep``)."""
    head = list(keep) + ([target] if target in df.columns else [])
    feats = [c for c in S.NUMERIC_FEATURES if c in df.columns]
    return df.select(*head, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                              for c in feats])


def assemble(df: DataFrame, feature_cols: Sequence[str] | None = None,
             target: str = S.TARGET_COL, output: str = "features") -> DataFrame:
    """P10: vector column of the present features + ``label`` (0 when there is no target)."""
    cols = [c for c in (feature_cols or S.NUMERIC_FEATURES) if c in df.columns]
    va = VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="keep")
    out = va.transform(df)
    label = F.col(target).cast("double") if target in df.columns else F.lit(0.0)
    return out.withColumn("label", label)


def _split_date(df: DataFrame) -> F.Column:
    for c in ("FlightDate", "fl_date"):
        if c in df.columns:
            return F.col(c).try_cast("date")
    raise KeyError("the split needs a flight date: no column FlightDate or fl_date")


def temporal_split(df: DataFrame, train_months: Iterable[int] = S.TRAIN_MONTHS,
                   test_months: Iterable[int] = S.TEST_MONTHS) -> tuple[DataFrame, DataFrame]:
    """train = months 1-10, test = months 11-12.

    A ``month`` column (the partition column of a table written by
    ``sources.flights.write_flights``) is filtered directly, so the other months' folders are
    not read; otherwise the month is computed from the flight date."""
    if "month" in df.columns:
        m = F.col("month").cast("int")
        if isinstance(df.schema["month"].dataType, T.IntegerType):
            m = F.col("month")
    else:
        m = F.month(_split_date(df))
    return df.where(m.isin(list(train_months))), df.where(m.isin(list(test_months)))


def scoring_input(df: DataFrame) -> DataFrame:
    """Fill any missing input column with its default (fl_date -> today)."""
    add = {c: F.lit(v) for c, v in S.SCORING_DEFAULTS.items() if c not in df.columns}
    if "fl_date" not in df.columns:
        add["fl_date"] = F.current_date()
    return df.withColumns(add) if add else df


class FlightFeaturizerModel:
    """L7 transform: temporal, weather and airport groups, then the fitted route encoder.
    ``rates`` is the training rows' airport-day table: without other history, unlabelled
    flights get their rolling rates from it."""

    def __init__(self, encoder: TargetEncoderModel, hubs: Iterable[str] = S.HUB_AIRPORTS,
                 grid: str = "active", pad_days: int = 0, rates: DataFrame | None = None):
        self.encoder = encoder
        self.hubs = list(hubs)
        self.grid = grid
        self.pad_days = pad_days
        self.rates = rates

    def features(self, df: DataFrame, history: DataFrame | None = None,
                 rates: DataFrame | None = None) -> DataFrame:
        if rates is None and history is None and S.TARGET_COL not in df.columns:
            rates = self.rates
        f = map_casing(df)
        f = FE.add_temporal_features(f, pad_days=self.pad_days)
        f = FE.add_weather_features(f)
        f = FE.add_airport_features(f, history=history, hubs=self.hubs, grid=self.grid, rates=rates)
        return self.encoder.transform(f)

    def transform(self, df: DataFrame, history: DataFrame | None = None,
                  keep: Sequence[str] = (), rates: DataFrame | None = None) -> DataFrame:
        """Aligned feature table. ``history`` (labelled flights) or ``rates`` (an airport-day
        table) give the rolling rates; they only look back, so all history can be passed.
        Default: ``df`` itself when it is labelled, else the saved table of the training rows."""
        return align_features(self.features(df, history, rates), keep=keep)

    def save(self, path: str) -> None:
        """Encoder state, airport-day table and settings under ``path``."""
        self.encoder.save(path)
        spark = self.encoder.routes.sparkSession
        meta = {"hubs": self.hubs, "grid": self.grid, "pad_days": self.pad_days,
                "rates": self.rates is not None}
        if self.rates is not None:
            self.rates.write.mode("overwrite").parquet(os.path.join(path, "airport_days"))
        (spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1)
              .write.mode("overwrite").text(os.path.join(path, "settings")))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FlightFeaturizerModel":
        meta = json.loads(spark.read.text(os.path.join(path, "settings")).first()[0])
        rates = spark.read.parquet(os.path.join(path, "airport_days")) if meta["rates"] else None
        return cls(TargetEncoderModel.load(spark, path), hubs=meta["hubs"], grid=meta["grid"],
                   pad_days=meta["pad_days"], rates=rates)


class FlightFeaturizer:
    """L7 fit: learns the route/carrier encodings and the airport-day table from the training
    rows only."""

    def __init__(self, smoothing: int = S.SMOOTHING, hubs: Iterable[str] = S.HUB_AIRPORTS,
                 grid: str = "active", pad_days: int = 0):
        self.smoothing = smoothing
        self.hubs = list(hubs)
        self.grid = grid
        self.pad_days = pad_days

    def fit(self, train: DataFrame) -> FlightFeaturizerModel:
        rows = map_casing(train)
        enc = TargetEncoder(smoothing=self.smoothing).fit(rows)
        rates = (FE.airport_daily_rates(rows)
                 if {S.TARGET_COL, "fl_date", "origin", "dest"} <= set(rows.columns) else None)
        return FlightFeaturizerModel(enc, self.hubs, self.grid, self.pad_days, rates)

    def fit_transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return self.fit(df).transform(df, keep=keep)
