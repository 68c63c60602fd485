"""Weather enrichment of flights: units (C11), needed station-months (J7, A10) and the
nearest-observation attachment at origin and destination (J6 applied to flights)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark import schemas as S
from ontime_spark.functions import weather as WF
from ontime_spark.operators.asof import asof_matches


def observation_features(obs: DataFrame) -> DataFrame:
    """C11: metric observations -> feature units (kt, statute miles, feet, deg F, in/hr).

    A missing ceiling or visibility means unlimited and becomes the clear-sky default; gust,
    precipitation and present weather are absent from the mandatory section, so precipitation
    is 0 and the weather flags are 0."""
    return obs.select(
        *[c for c in obs.columns if c in ("airport", "station_id", "timestamp", "obs_id")],
        WF.ms_to_knots("wind_speed_ms").alias("wind_speed"),
        F.coalesce(WF.m_to_miles("visibility_m"),
                   F.lit(S.WEATHER_DEFAULTS["visibility"])).alias("visibility"),
        F.coalesce(WF.m_to_feet("ceiling_m"),
                   F.lit(float(S.WEATHER_DEFAULTS["ceiling"]))).alias("ceiling"),
        WF.c_to_f("temp_c").alias("temp"),
        F.coalesce(WF.mm_to_inches("precip_mm"), F.lit(0.0)).alias("precip"),
        F.lit(0).alias("has_thunderstorm"), F.lit(0).alias("has_snow"), F.lit(0).alias("has_fog"),
    )


def needed_station_months(flights: DataFrame, station_map: DataFrame,
                          airport_cols: Sequence[str] = ("origin", "dest"),
                          date_col: str = "fl_date") -> DataFrame:
    """Distinct (airport, year, month) of the flights' ends, with the mapped station;
    airports without a station are skipped. Both ends by default, as ``attach_weather`` fills
    both."""
    d = F.col(date_col).try_cast("date")
    ends = flights.where(d.isNotNull()).select(
        F.explode(F.array(*[F.col(c) for c in airport_cols])).alias("airport"),
        F.year(d).alias("year"), F.month(d).alias("month"))
    sm = station_map.select(F.col("iata").alias("airport"), "station_id")
    return ends.where(F.col("airport").isNotNull()).distinct().join(sm, "airport")


def weather_for_flights(obs: DataFrame, needed: DataFrame) -> DataFrame:
    """Only the observations of the needed (station, year, month), tagged with the
    airport and ordered by (airport, timestamp) over all partitions."""
    o = obs.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})
    out = o.join(needed, ["station_id", "year", "month"], "inner").drop("year", "month")
    return out.repartitionByRange("airport", "timestamp").sortWithinPartitions("airport", "timestamp")


def enrich_flights(flights: DataFrame, observations: DataFrame, station_map: DataFrame,
                   flight_id: str, tz_col: str | None = None, tolerance_seconds: int = 3600) -> DataFrame:
    """Ingested flights and parsed observations to flights with weather at both ends: the needed
    station-months (J7), feature units (C11) and the nearest observation (J6). ``observations``
    has station_id, timestamp and the metric columns; flights without an observation in reach
    keep null weather, which the cleaning step fills."""
    obs = weather_for_flights(observations, needed_station_months(flights, station_map))
    obs = obs.withColumn("obs_id", F.xxhash64("airport", "timestamp", *sorted(
        c for c in obs.columns if c.endswith(("_c", "_m", "_ms", "_mm")))))
    return attach_weather(flights, observation_features(obs), flight_id, tolerance_seconds, tz_col=tz_col)


def scheduled_departure(date_col: str = "fl_date", time_col: str = "crs_dep_time",
                        tz_col: str | None = None) -> F.Column:
    """Timestamp of the scheduled departure (local HHMM; converted to UTC when a time-zone
    column is given, since ISD times are UTC)."""
    hhmm = F.col(time_col).cast("int")
    hh = F.least(F.floor(hhmm / 100), F.lit(23)).cast("int")
    mm = (hhmm % 100).cast("int")
    ts = F.make_timestamp(F.year(date_col), F.month(date_col), F.dayofmonth(date_col), hh, mm,
                          F.lit(0))
    return F.to_utc_timestamp(ts, F.col(tz_col)) if tz_col else ts


def attach_weather(flights: DataFrame, obs_features: DataFrame, flight_id: str,
                   tolerance_seconds: int = 3600, direction: str = "nearest",
                   tz_col: str | None = None) -> DataFrame:
    """J6 for flights: the observation closest to the scheduled departure at the origin and at
    the destination fills ``{side}_{wind_speed,visibility,ceiling,temp,precip,has_*}``.
    ``obs_features`` needs airport, timestamp, obs_id and the feature-unit columns."""
    cols = list(S.RAW_WEATHER_SUFFIXES)
    sides = ("origin", "dest")
    # Both ends of a flight are rows of one scan, so the observations move once; what they found is
    # folded back by flight and joined once.
    ends = flights.select(F.col(flight_id).alias("_flight"), scheduled_departure(tz_col=tz_col).alias("_sched"),
                          F.inline(F.array(*[F.struct(F.lit(s).alias("_side"), F.col(s).alias("airport")) for s in sides])))
    ends = ends.select("airport", "_sched", F.struct("_flight", "_side").alias("_end"))
    right = obs_features.select("airport", "timestamp", "obs_id", *cols)
    found = asof_matches(ends, right, "airport", "_sched", "timestamp", "_end", "obs_id", tolerance_seconds, direction, cols)
    own = found.groupBy(F.col("_end._flight").alias(flight_id)).agg(
        *[F.max(F.when(F.col("_end._side") == s, F.col("_rv"))).alias(f"_{s}") for s in sides])
    kept = flights.drop(*[f"{s}_{c}" for s in sides for c in cols])
    return kept.join(own, flight_id, "left").select(
        *kept.columns, *[F.col(f"_{s}.{c}").alias(f"{s}_{c}") for s in sides for c in cols])
