"""ADS-B aggregates: aircraft near airports (J8) and flight counts per route and hour.

J8 is a range condition (|lat - a.lat| <= bbox, |lon - a.lon| <= bbox). With cells of side
2*bbox, an airport's box touches at most 2 x 2 cells, so the airports are exploded to those
cells and equi-joined with the states on the cell key; the exact bounds are then applied.
No nested-loop join and no states x airports product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cell(c: F.Column, size: float) -> F.Column:
    return F.floor(c / size).cast("long")


def aircraft_near_airports(states: DataFrame, airports: DataFrame, bbox_deg: float = 0.5,
                           key: str = "icao", by_time: bool = False) -> DataFrame:
    """Number of aircraft states inside each airport's box; airports without coordinates
    or without aircraft get 0. With ``by_time`` the count is per snapshot ``time``."""
    size = 2 * bbox_deg
    a = airports.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        key, "lat", "lon",
        F.explode(F.sequence(_cell(F.col("lat") - bbox_deg, size),
                             _cell(F.col("lat") + bbox_deg, size))).alias("_cy"))
    a = a.withColumn("_cx", F.explode(F.sequence(_cell(F.col("lon") - bbox_deg, size),
                                                 _cell(F.col("lon") + bbox_deg, size))))
    s = states.select(*(["time"] if by_time else []), F.col("lat").alias("_slat"),
                      F.col("lon").alias("_slon"),
                      _cell(F.col("lat"), size).alias("_cy"), _cell(F.col("lon"), size).alias("_cx"))
    hit = (s.join(a, ["_cy", "_cx"])
            .where(F.col("_slat").between(F.col("lat") - bbox_deg, F.col("lat") + bbox_deg)
                   & F.col("_slon").between(F.col("lon") - bbox_deg, F.col("lon") + bbox_deg)))
    group = [key, "time"] if by_time else [key]
    counts = hit.groupBy(*group).agg(F.count(F.lit(1)).alias("n_aircraft"))
    if by_time:
        return counts
    return (airports.select(key).distinct().join(counts, key, "left")
            .select(key, F.coalesce("n_aircraft", F.lit(0)).alias("n_aircraft")))


def aircraft_per_snapshot(states: DataFrame, airports: DataFrame, bbox_deg: float = 0.5, key: str = "icao",
                          every_seconds: int = 1) -> DataFrame:
    """J8 for every snapshot (``time`` rounded down to ``every_seconds``): key, time, n_aircraft of each airport
    at each snapshot that the states hold, zeros included.

    Counts come from the grid join; the zeros are added as rows of the calendar, one for each
    snapshot and airport (the size of the result), and summed with them, so no state meets an
    airport outside its cells."""
    at = (F.floor(F.col("time") / every_seconds) * every_seconds).cast("long")
    states = states.withColumn("time", at)
    counts = aircraft_near_airports(states, airports, bbox_deg, key, by_time=True)
    keys = airports.select(key).distinct().agg(F.collect_list(key)).first()[0]  # the airports of the world: some 10^4
    grid = states.select("time").distinct().select(F.explode(F.array(*[F.lit(k) for k in keys])).alias(key), "time")
    zeros = grid.withColumn("n_aircraft", F.lit(0).cast("long"))
    return counts.unionByName(zeros).groupBy(key, "time").agg(F.sum("n_aircraft").alias("n_aircraft"))


def flights_per_route_hour(adsb: DataFrame) -> DataFrame:
    """Observed flights per (departure, arrival, hour of first sighting)."""
    return (adsb.groupBy(F.col("estDepartureAirport").alias("dep"),
                         F.col("estArrivalAirport").alias("arr"),
                         F.date_trunc("hour", "firstSeen").alias("hour"))
                .agg(F.count(F.lit(1)).alias("n_flights")))


def movements_per_airport(adsb: DataFrame) -> DataFrame:
    """Departures and arrivals per airport (one pass, one shuffle)."""
    ends = F.array(
        F.struct(F.col("estDepartureAirport").alias("airport"), F.lit(1).alias("d"),
                 F.lit(0).alias("a")),
        F.struct(F.col("estArrivalAirport").alias("airport"), F.lit(0).alias("d"),
                 F.lit(1).alias("a")))
    return (adsb.select(F.inline(ends)).where(F.col("airport").isNotNull())
                .groupBy("airport")
                .agg(F.sum("d").cast("long").alias("departures"),
                     F.sum("a").cast("long").alias("arrivals")))
