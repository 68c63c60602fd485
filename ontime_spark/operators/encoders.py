"""Fitted encoders: smoothed target encoding of route and carrier (A3-A5, J3), ordinal
encoding of the categoricals (M5) and class weights (A7).

Fitted state is a pair of small DataFrames (one row per category) written to the shared
checkpoint folder, so transforms never recompute the training aggregation and survive
executor loss. The state joins are broadcast only after the state's row count (known at
fit time) is checked against ``max_broadcast_rows``; above it a regular shuffle join is used.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime_spark import schemas as S
from ontime_spark.functions import route as R
from ontime_spark.session import materialize

MAX_BROADCAST_ROWS = 1_000_000


def resolve_carrier_col(df: DataFrame) -> str:
    for c in S.CARRIER_CANDIDATES:
        if c in df.columns:
            return c
    raise KeyError("the table has none of the carrier columns "
                   + ", ".join(S.CARRIER_CANDIDATES))


def _airport_cols(df: DataFrame) -> tuple[str, str]:
    if "Origin" in df.columns and "Dest" in df.columns:
        return "Origin", "Dest"
    return "origin", "dest"


def global_mean(df: DataFrame, target: str = S.TARGET_COL) -> DataFrame:
    """A3: one-row mean of the label."""
    return df.agg(F.avg(F.col(target).cast("double")).alias("global_mean"))


def smoothed_encoding(df: DataFrame, key: str | F.Column, name: str, g: float | F.Column,
                      smoothing: int, target: str = S.TARGET_COL) -> DataFrame:
    """A4: per category (key, n, mean, value) with value = (n*mean + m*g) / (n + m)."""
    k = F.col(key) if isinstance(key, str) else key
    gm = F.lit(g) if not isinstance(g, F.Column) else g
    agg = (df.select(k.alias(name), F.col(target).cast("double").alias("_y"))
             .where(F.col(name).isNotNull())
             .groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean")))
    return agg.withColumn("value", (F.col("n") * F.col("mean") + F.lit(smoothing) * gm)
                          / (F.col("n") + F.lit(smoothing)))


def _join_state(df: DataFrame, state: DataFrame, key: F.Column, n_rows: int,
                max_rows: int) -> DataFrame:
    side = F.broadcast(state) if n_rows <= max_rows else state
    return df.withColumn("_k", key).join(side.withColumnRenamed(state.columns[0], "_k"),
                                         "_k", "left").drop("_k")


class TargetEncoderModel:
    """A5 transform (J3): route/carrier -> encoded value, unseen -> global mean."""

    def __init__(self, global_mean: float, routes: DataFrame, carriers: DataFrame,
                 n_routes: int, n_carriers: int, smoothing: int,
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS):
        self.global_mean = global_mean
        self.routes, self.carriers = routes, carriers
        self.n_routes, self.n_carriers = n_routes, n_carriers
        self.smoothing = smoothing
        self.max_broadcast_rows = max_broadcast_rows

    def transform(self, df: DataFrame, extra_columns: bool = True) -> DataFrame:
        o, d = _airport_cols(df)
        ccol = resolve_carrier_col(df)
        route = R.route_key(o, d)
        g = F.lit(self.global_mean)
        out = _join_state(df, self.routes.select("route", F.col("value").alias("_route_v")),
                          route, self.n_routes, self.max_broadcast_rows)
        out = _join_state(out, self.carriers.select("carrier_key", F.col("value").alias("_car_v")),
                          F.col(ccol).cast("string"), self.n_carriers, self.max_broadcast_rows)
        cols = {"route_avg_delay": F.coalesce(F.col("_route_v"), g),
                "carrier_delay_rate": F.coalesce(F.col("_car_v"), g)}
        if extra_columns:
            cols["route"] = route
            dist = "Distance" if "Distance" in df.columns else "distance"
            if dist in df.columns:
                cols["distance_category"] = R.distance_category(dist)
        return out.withColumns(cols).drop("_route_v", "_car_v")

    # -- persistence: state tables as Parquet, scalars as JSON
    def save(self, path: str) -> None:
        self.routes.write.mode("overwrite").parquet(os.path.join(path, "routes"))
        self.carriers.write.mode("overwrite").parquet(os.path.join(path, "carriers"))
        meta = {"global_mean": self.global_mean, "n_routes": self.n_routes,
                "n_carriers": self.n_carriers, "smoothing": self.smoothing}
        spark = self.routes.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").text(os.path.join(path, "meta"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TargetEncoderModel":
        meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
        return cls(meta["global_mean"], spark.read.parquet(os.path.join(path, "routes")),
                   spark.read.parquet(os.path.join(path, "carriers")),
                   meta["n_routes"], meta["n_carriers"], meta["smoothing"])


class TargetEncoder:
    """A5 fit: smoothed target encoding of route ('ORIGIN-DEST') and carrier."""

    def __init__(self, smoothing: int = S.SMOOTHING, target: str = S.TARGET_COL,
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS, checkpoint: bool = True):
        self.smoothing = smoothing
        self.target = target
        self.max_broadcast_rows = max_broadcast_rows
        self.checkpoint = checkpoint

    def cells(self, df: DataFrame, *by: F.Column) -> DataFrame:
        """Rows, label sum and labelled rows per (``by``, route, carrier): what the encoder is
        made of, and what two sets of flights can be added in."""
        o, d = _airport_cols(df)
        ccol = resolve_carrier_col(df)
        y = F.col(self.target).cast("double")
        return (df.groupBy(*by, R.route_key(o, d).alias("route"), F.col(ccol).cast("string").alias("carrier_key"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.count(y).alias("ny")))

    def fit(self, df: DataFrame) -> TargetEncoderModel:
        """One pass over the rows: label count and sum per (route, carrier), a table bounded by
        routes x carriers. Route stats, carrier stats and the global mean are re-aggregated
        from it."""
        return self.fit_cells(self.cells(df))

    def fit_cells(self, cells: DataFrame) -> TargetEncoderModel:
        """The encoder from ``cells`` (several rows of a route and carrier add up)."""
        if self.checkpoint:
            cells = materialize(cells, "encoder-cells")
        tot = cells.agg(F.sum("s").alias("s"), F.sum("ny").alias("ny")).first()
        g = float(tot["s"] / tot["ny"]) if tot["ny"] else 0.0
        m = F.lit(self.smoothing)

        def encode(key: str) -> DataFrame:
            st = (cells.where(F.col(key).isNotNull()).groupBy(key)
                       .agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("ny")).alias("mean")))
            return st.withColumn("value", (F.col("n") * F.col("mean") + m * F.lit(g))
                                 / (F.col("n") + m))

        routes, carriers = encode("route"), encode("carrier_key")
        if self.checkpoint:
            routes, carriers = materialize(routes, "routes"), materialize(carriers, "carriers")
        return TargetEncoderModel(g, routes, carriers, routes.count(), carriers.count(),
                                  self.smoothing, self.max_broadcast_rows)


class OrdinalEncoderModel:
    """M5 transform: category -> index in the sorted training categories, unseen -> -1."""

    def __init__(self, tables: dict[str, DataFrame], sizes: dict[str, int],
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS):
        self.tables, self.sizes = tables, sizes
        self.max_broadcast_rows = max_broadcast_rows

    def transform(self, df: DataFrame, passthrough: Sequence[str] | None = None) -> DataFrame:
        out = df
        for c, t in self.tables.items():
            out = _join_state(out, t.select("category", F.col("code").alias(f"_code_{c}")),
                              F.col(c).cast("string"), self.sizes[c], self.max_broadcast_rows)
            out = out.withColumn(c, F.coalesce(F.col(f"_code_{c}"), F.lit(-1))).drop(f"_code_{c}")
        if passthrough is not None:
            out = out.select(*self.tables.keys(), *[c for c in passthrough if c not in self.tables])
        return out

    def save(self, path: str) -> None:
        """The code tables under ``path``, one folder per column."""
        for c, t in self.tables.items():
            t.write.mode("overwrite").parquet(os.path.join(path, f"column={c}"))

    @classmethod
    def load(cls, spark: SparkSession, path: str, columns: Sequence[str] = S.CATEGORICAL_FEATURES
             ) -> "OrdinalEncoderModel":
        tables = {c: spark.read.parquet(os.path.join(path, f"column={c}")) for c in columns}
        return cls(tables, {c: t.count() for c, t in tables.items()})


class OrdinalEncoder:
    """M5 fit: sorted distinct categories per column, code = rank - 1.

    The rank is a running count over the distinct categories (``cumulative.running_totals``):
    a column with many categories (routes) is range-bucketed rather than ranked in one task.
    ``rows_per_bucket`` overrides the bucketing threshold (tests)."""

    def __init__(self, columns: Sequence[str] = S.CATEGORICAL_FEATURES, checkpoint: bool = True,
                 rows_per_bucket: int | None = None):
        self.columns = list(columns)
        self.checkpoint = checkpoint
        self.rows_per_bucket = rows_per_bucket

    def fit(self, df: DataFrame) -> OrdinalEncoderModel:
        from ontime_spark.operators.cumulative import running_totals
        tables, sizes = {}, {}
        for c in self.columns:
            cats = df.select(F.col(c).cast("string").alias("category")).where(
                F.col("category").isNotNull()).distinct().withColumn("_one", F.lit(1))
            ranked = running_totals(cats, [], "category", ["_one"], prefix="_rank",
                                    rows_per_bucket=self.rows_per_bucket)
            t = ranked.select("category", (F.col("_rank_one") - 1).cast("int").alias("code"))
            if self.checkpoint:
                t = materialize(t, f"codes-{c}")
            tables[c], sizes[c] = t, t.count()
        return OrdinalEncoderModel(tables, sizes)


def class_weights(df: DataFrame, label: str = S.TARGET_COL) -> DataFrame:
    """Per class (label, n, weight = N / (2 n_c)) and scale_pos_weight = n_neg / n_pos."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # over the class-count table: one row per class
    n_all = F.sum("n").over(everything)
    n_neg = F.sum(F.when(F.col(label) == 0, F.col("n"))).over(everything)
    n_pos = F.sum(F.when(F.col(label) == 1, F.col("n"))).over(everything)
    return counts.select(label, "n", (n_all / (2.0 * F.col("n"))).alias("weight"),
                         (n_neg / n_pos).alias("scale_pos_weight"))
