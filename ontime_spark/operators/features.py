"""Feature groups: temporal (L2), weather (P5, L3), airport (A1/J1, A2, W1, J2, P13, L4),
route (L5) and ``build_features`` (L6).

Plan shape of the airport group: one aggregation over the flights exploded to their two ends
(origin, dest) yields a small table keyed by (side, airport, date) carrying the per-hour flight
counts (a map of at most 24 entries) and the leakage-safe rolling delay rate. It is written once
and each side joins it, so the group costs one shuffle of partial aggregates and two joins of
the flight rows (AQE turns them into broadcasts when the table proves small and splits skewed
airport-days).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime_spark import schemas as S
from ontime_spark.functions import route as R
from ontime_spark.functions import temporal as TF
from ontime_spark.functions import weather as WF
from ontime_spark.session import materialize

SIDES = ("origin", "dest")


# ---------------------------------------------------------------- temporal (L2)
def add_temporal_features(df: DataFrame, date_col: str = "fl_date",
                          time_col: str = "crs_dep_time", pad_days: int = 0,
                          with_time_block: bool = False) -> DataFrame:
    """L2: hour, weekday (0=Mon), month, weekend, holiday (exact date, or +-``pad_days``),
    cyclic encodings; optionally the time block."""
    d = F.col(date_col).try_cast("date")
    df = df.withColumns({
        "hour_of_day": TF.hour_of_day(time_col),
        "day_of_week": TF.day_of_week(d),
        "month": TF.month(d),
        "is_weekend": TF.is_weekend(d),
        "is_holiday": TF.is_holiday(d, pad_days),
    })
    hs, hc = TF.cyclic("hour_of_day", 24)
    ms, mc = TF.cyclic("month", 12)
    cols = {"hour_sin": hs, "hour_cos": hc, "month_sin": ms, "month_cos": mc}
    if with_time_block:
        cols["time_block"] = TF.time_block("hour_of_day")
    return df.withColumns(cols)


# ---------------------------------------------------------------- weather (P5, L3)
def ensure_weather_columns(df: DataFrame) -> DataFrame:
    """P5: add any of the 16 raw weather columns that are absent, with their defaults."""
    missing = {}
    for side in SIDES:
        for suffix, default in S.WEATHER_DEFAULTS.items():
            c = f"{side}_{suffix}"
            if c not in df.columns:
                missing[c] = F.lit(default).cast("double" if isinstance(default, float) else "int")
    return df.withColumns(missing) if missing else df


def add_weather_features(df: DataFrame, extended: bool = False) -> DataFrame:
    """L3: IFR flags per side; ``extended`` adds wind category and severe-weather flags."""
    df = ensure_weather_columns(df)
    cols = {f"ifr_conditions_{side}": WF.ifr(f"{side}_ceiling", f"{side}_visibility")
            for side in SIDES}
    if extended:
        for side in SIDES:
            cols[f"{side}_wind_category"] = WF.wind_category(f"{side}_wind_speed")
            cols[f"severe_weather_{side}"] = WF.severe_weather(
                f"{side}_has_thunderstorm", f"{side}_has_snow", f"{side}_wind_speed")
    return df.withColumns(cols)


# ---------------------------------------------------------------- airport
def flights_per_hour(df: DataFrame, side: str, date_col: str = "fl_date",
                     hour_col: str = "hour_of_day") -> DataFrame:
    """A1: scheduled flights per (airport, date, hour): columns airport, date, hour, n."""
    return (df.where(F.col(side).isNotNull() & F.col(date_col).isNotNull()
                     & F.col(hour_col).isNotNull())
              .groupBy(side, date_col, hour_col).agg(F.count(F.lit(1)).alias("n")))


def daily_delay_rate(history: DataFrame, side: str, date_col: str = "fl_date",
                     target: str = S.TARGET_COL) -> DataFrame:
    """A2: mean label per (airport, date)."""
    return (history.where(F.col(side).isNotNull() & F.col(date_col).isNotNull())
                   .groupBy(side, date_col)
                   .agg(F.avg(F.col(target).cast("double")).alias("daily_rate")))


def rolling_delay_rate(history: DataFrame, side: str, grid: str = "active",
                       window: int = S.ROLLING_WINDOW, date_col: str = "fl_date",
                       target: str = S.TARGET_COL, name: str | None = None) -> DataFrame:
    """Mean of the daily rates of the previous ``window`` grid days (today excluded),
    null when there is none.

    grid='active': the previous ``window`` days on which the airport had flights.
    grid='dense' : the previous ``window`` dates of the whole data set (days without flights
                   at that airport count as missing and are skipped). Computed as a range frame
                   over a dense date index, without materialising airports x dates.
    """
    name = name or f"{side}_delay_rate_rolling"
    daily = daily_delay_rate(history, side, date_col, target)
    if grid == "active":
        w = Window.partitionBy(side).orderBy(date_col).rowsBetween(-window, -1)
    elif grid == "dense":
        # Distinct dates are bounded by the calendar (366 per year), so ranking them in one
        # task and broadcasting the index is safe at any data volume.
        dates = history.where(F.col(date_col).isNotNull()).select(date_col).distinct()
        idx = dates.withColumn("_date_idx", F.dense_rank().over(Window.orderBy(date_col)))
        daily = daily.join(F.broadcast(idx), date_col)
        w = Window.partitionBy(side).orderBy("_date_idx").rangeBetween(-window, -1)
    else:
        raise ValueError(f"grid must be 'active' or 'dense', not {grid!r}")
    return daily.select(side, date_col, "daily_rate", F.avg("daily_rate").over(w).alias(name))


def hub_flags(df: DataFrame, hubs: Iterable[str] = S.HUB_AIRPORTS) -> DataFrame:
    """P13."""
    hubs = list(hubs)
    return df.withColumns({
        "is_origin_hub": F.col("origin").isin(hubs).cast("int"),
        "is_dest_hub": F.col("dest").isin(hubs).cast("int"),
    })


def _both_sides(df: DataFrame, date_col: str, extra: list) -> DataFrame:
    """Each flight as two rows (side='origin'/'dest', airport), with the given columns."""
    ends = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("airport"))
                     for side in SIDES])
    return df.select(F.col(date_col).alias("_date"), *extra, F.inline(ends))


def airport_daily_rates(history: DataFrame, date_col: str = "fl_date",
                        target: str = S.TARGET_COL) -> DataFrame:
    """The airport-day table that scoring needs: (side, airport, date, daily_rate), the mean
    label of each airport's days as origin and as destination. One row per airport and day."""
    ends = _both_sides(history, date_col, [F.col(target).cast("double").alias("_y")])
    return (ends.where(F.col("airport").isNotNull() & F.col("_date").isNotNull())
                .groupBy("side", "airport", F.col("_date").cast("date").alias("date"))
                .agg(F.avg("_y").alias("daily_rate")))


def rates_before(keys: DataFrame, rates: DataFrame, grid: str = "active",
                 window: int = S.ROLLING_WINDOW) -> DataFrame:
    """``keys`` (side, airport, _date, ...) plus ``_roll``: the mean daily rate of the last
    ``window`` grid days of ``rates`` strictly before each key's date, null when there is none.
    A key's date need not occur in ``rates``: a future date looks back at the newest days.

    Rates and keys are ordered together per airport; no row is compared with another one."""
    own = [c for c in keys.columns if c not in ("side", "airport", "_date")]
    day = F.unix_date(F.col("_date").cast("date"))
    asked = keys.select("side", "airport", "_date", F.struct(F.lit(1).alias("_one"), *own).alias("_key"))
    known = rates.select("side", "airport", F.col("date").alias("_date"), "daily_rate")
    if grid == "active":
        back = Window.partitionBy("side", "airport").orderBy("_date").rowsBetween(1 - window, 0)
        known = known.select("side", "airport", "_date", F.avg("daily_rate").over(back).alias("_value"))
        frame = (Window.partitionBy("side", "airport").orderBy("_day")
                 .rangeBetween(Window.unboundedPreceding, -1))
        roll = F.last("_value", ignorenulls=True).over(frame)
        both = known.unionByName(asked, allowMissingColumns=True).withColumn("_day", day)
    elif grid == "dense":
        # Dates are bounded by the calendar: one task numbers them, the index is broadcast. A
        # date without history stands right after the last history date before it.
        dates = (known.select("_date", F.lit(1).alias("h")).union(asked.select("_date", F.lit(0)))
                 .groupBy("_date").agg(F.max("h").alias("h")))
        before = Window.orderBy("_date").rowsBetween(Window.unboundedPreceding, -1)
        idx = dates.select("_date", (F.coalesce(F.sum("h").over(before), F.lit(0)) + 1).alias("_day"))
        frame = Window.partitionBy("side", "airport").orderBy("_day").rangeBetween(-window, -1)
        roll = F.avg("_value").over(frame)
        both = (known.withColumnRenamed("daily_rate", "_value")
                .unionByName(asked, allowMissingColumns=True).join(F.broadcast(idx), "_date"))
    else:
        raise ValueError(f"grid must be 'active' or 'dense', not {grid!r}")
    return (both.withColumn("_roll", roll).where(F.col("_key").isNotNull())
                .select("side", "airport", "_date", *[F.col("_key")[c].alias(c) for c in own], "_roll"))


def airport_day_table(df: DataFrame, history: DataFrame | None = None, grid: str = "active",
                      window: int = S.ROLLING_WINDOW, date_col: str = "fl_date",
                      target: str = S.TARGET_COL, rates: DataFrame | None = None) -> DataFrame:
    """Per (side, airport, date) of ``df``: ``_hour_counts`` (hour -> scheduled flights) and
    ``_roll`` (W1 rolling delay rate).

    The rates come from ``rates`` (an ``airport_daily_rates`` table, e.g. a saved one), else
    from ``history``, else from ``df`` itself when it is labelled; without any of them ``_roll``
    is null. Both sides come out of one aggregation over the flights exploded to
    (origin, dest): one shuffle of partial aggregates instead of one per side and feature."""
    hour_ok = "hour_of_day" in df.columns
    same = rates is None and history is None and target in df.columns
    if rates is None and history is not None and target in history.columns:
        rates = airport_daily_rates(history, date_col, target)
    y = [F.col(target).cast("double").alias("_y")] if same else []
    ex = _both_sides(df, date_col, ([F.col("hour_of_day")] if hour_ok else [F.lit(None).cast("int").alias("hour_of_day")]) + y)
    ex = ex.where(F.col("airport").isNotNull() & F.col("_date").isNotNull())
    per_hour = ex.groupBy("side", "airport", "_date", "hour_of_day").agg(
        F.count(F.lit(1)).alias("n"),
        *([F.sum("_y").alias("s"), F.count("_y").alias("ny")] if y else []))
    daily = per_hour.groupBy("side", "airport", "_date").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("hour_of_day").isNotNull(),
                                                  F.struct("hour_of_day", "n")))).alias("_hour_counts"),
        *([(F.sum("s") / F.sum("ny")).alias("daily_rate")] if y else []))
    if same:
        own = materialize(daily, "airport-days")
        return rates_before(own.drop("daily_rate"),
                            own.select("side", "airport", F.col("_date").cast("date").alias("date"), "daily_rate"),
                            grid, window)
    if rates is None:
        return daily.withColumn("_roll", F.lit(None).cast("double"))
    return rates_before(daily, rates, grid, window)


def add_airport_features(df: DataFrame, history: DataFrame | None = None,
                         hubs: Iterable[str] = S.HUB_AIRPORTS, grid: str = "active",
                         window: int = S.ROLLING_WINDOW, date_col: str = "fl_date",
                         target: str = S.TARGET_COL, rates: DataFrame | None = None) -> DataFrame:
    """L4: congestion counts (J1), rolling delay rates re-attached (J2), hub flags.

    ``history`` (labelled flights) or ``rates`` (their saved airport-day table) supply the
    rolling rates; they only look back, so passing all history when transforming a later
    period does not leak. The (side, airport, date) table that carries both features is
    written once and joined by each side."""
    table = materialize(airport_day_table(df, history, grid, window, date_col, target, rates),
                        "airport-features")
    hour_ok = "hour_of_day" in df.columns
    for side in SIDES:
        part = (table.where(F.col("side") == side)
                     .select(F.col("airport").alias(side), F.col("_date").alias(date_col),
                             "_hour_counts", "_roll"))
        df = df.join(part, [side, date_col], "left")
        cnt = (F.coalesce(F.try_element_at("_hour_counts", F.col("hour_of_day")), F.lit(0))
               if hour_ok else F.lit(0))
        df = df.withColumns({f"{side}_flights_per_hour": cnt.cast("int"),
                             f"{side}_delay_rate_rolling": F.coalesce(F.col("_roll"), F.lit(0.0))}
                            ).drop("_hour_counts", "_roll")
    return hub_flags(df, hubs)


# ---------------------------------------------------------------- route
def add_route_features(df: DataFrame, smoothing: int = S.SMOOTHING,
                       target: str = S.TARGET_COL) -> DataFrame:
    """In-sample target encoding of route and carrier with a fresh encoder, plus the route
    key and distance category. Without a label both encodings are 0."""
    from ontime_spark.operators.encoders import TargetEncoder

    if target not in df.columns:
        return df.withColumns({"route_avg_delay": F.lit(0.0), "carrier_delay_rate": F.lit(0.0)})
    return TargetEncoder(smoothing=smoothing, target=target).fit(df).transform(df)


def add_route_columns(df: DataFrame) -> DataFrame:
    """C12/C13 helper columns."""
    cols = {"route": R.route_key("origin", "dest")}
    if "distance" in df.columns:
        cols["distance_category"] = R.distance_category("distance")
    return df.withColumns(cols)


# ---------------------------------------------------------------- all
def build_features(df: DataFrame, hubs: Iterable[str] = S.HUB_AIRPORTS, grid: str = "active",
                   history: DataFrame | None = None) -> DataFrame:
    """Temporal -> weather -> airport -> route (in-sample encodings, fitted on the input
    rows before the airport joins, which the encoder does not need)."""
    from ontime_spark.operators.encoders import TargetEncoder

    encoder = TargetEncoder().fit(df) if S.TARGET_COL in df.columns else None
    df = add_temporal_features(df)
    df = add_weather_features(df)
    df = add_airport_features(df, history=history, hubs=hubs, grid=grid)
    return encoder.transform(df) if encoder else add_route_features(df)
