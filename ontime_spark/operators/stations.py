"""Airport -> weather station mapping (J4 exact ICAO, J5 nearest fallback).

J5 is an exact nearest-neighbour search on a grid, not an airports x stations product:
each round equi-joins the unresolved airports' 3 x 3 block of cells with the stations of
those cells, keeps the airports whose best candidate is provably the nearest, and retries the
rest with cells twice as large. The loop runs a handful of distributed joins over the (small)
set of unresolved airports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime_spark.session import materialize

CELL_DEG = 1.0


def us_stations(stations: DataFrame) -> DataFrame:
    """US stations with both coordinates."""
    return stations.where((F.col("CTRY") == "US") & F.col("LAT").isNotNull()
                          & F.col("LON").isNotNull())


def _station_id() -> F.Column:
    return F.concat_ws("-", F.col("USAF"), F.col("WBAN"))


def exact_icao_match(airports: DataFrame, stations: DataFrame) -> DataFrame:
    """First US station (by USAF, WBAN) whose ICAO equals the airport's upper-cased ICAO.
    Rows: iata, station_id."""
    st = us_stations(stations).select("USAF", "WBAN", F.col("ICAO").alias("_icao"))
    cand = airports.select("iata", F.upper("icao").alias("_icao")).join(st, "_icao")
    w = Window.partitionBy("iata").orderBy("USAF", "WBAN")
    return (cand.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
                .select("iata", _station_id().alias("station_id")))


def nearest_station(airports: DataFrame, stations: DataFrame, cell_deg: float = CELL_DEG,
                    max_cell_deg: float = 512.0) -> DataFrame:
    """Nearest US station by squared degree distance; ties -> smaller (USAF, WBAN).
    Rows: iata, station_id, d2. Airports without coordinates are skipped.

    Each round probes the 3 x 3 block of cells of side ``s`` around every unresolved airport
    (an equi-join on the cell key, 9 probe rows per airport). A best candidate with
    d2 <= s^2 is provably the nearest: a station outside the block is more than ``s`` away in
    latitude or longitude. The rest retry with ``s`` doubled; once a block spans the globe
    every remaining best candidate is final."""
    # Station coordinates are renamed: Spark resolves LAT and lat to the same name.
    st = us_stations(stations).select("USAF", "WBAN", F.col("LAT").alias("_slat"),
                                      F.col("LON").alias("_slon"))
    todo = airports.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()) \
        .select("iata", "lat", "lon")
    offs = F.array(F.lit(-1), F.lit(0), F.lit(1))
    found: DataFrame | None = None
    size = cell_deg
    while True:
        cell = lambda c: F.floor(c / F.lit(size)).cast("long")
        probe = (todo.withColumn("_dy", F.explode(offs)).withColumn("_dx", F.explode(offs))
                     .select("iata", "lat", "lon", (cell(F.col("lat")) + F.col("_dy")).alias("_cy"),
                             (cell(F.col("lon")) + F.col("_dx")).alias("_cx")))
        st_cells = st.select("*", cell(F.col("_slat")).alias("_cy"), cell(F.col("_slon")).alias("_cx"))
        cand = probe.join(st_cells, ["_cy", "_cx"]).select(
            "iata", "USAF", "WBAN",
            ((F.col("_slat") - F.col("lat")) * (F.col("_slat") - F.col("lat"))
             + (F.col("_slon") - F.col("lon")) * (F.col("_slon") - F.col("lon"))).alias("d2"))
        best = cand.groupBy("iata").agg(
            F.min_by(F.struct("d2", "USAF", "WBAN"), F.struct("d2", "USAF", "WBAN")).alias("b"))
        best = best.select("iata", F.col("b.d2").alias("d2"),
                           F.concat_ws("-", "b.USAF", "b.WBAN").alias("station_id"))
        last = size >= max_cell_deg
        # Both tables are cut from their lineage: otherwise each round's plan would contain the
        # previous round's twice and grow exponentially.
        sure = materialize(best if last else best.where(F.col("d2") <= F.lit(size * size)),
                           "nearest-found")
        found = sure if found is None else found.unionByName(sure)
        if last:
            break
        todo = materialize(todo.join(sure.select("iata"), "iata", "left_anti"), "nearest-todo")
        if todo.isEmpty():
            break
        size *= 2
    return found


def map_airports_to_stations(airports: DataFrame, stations: DataFrame) -> DataFrame:
    """J4 then J5 for the airports without an ICAO match. Rows: iata, station_id, method."""
    exact = exact_icao_match(airports, stations).withColumn("method", F.lit("icao"))
    rest = airports.join(exact.select("iata"), "iata", "left_anti")
    near = nearest_station(rest, stations).select("iata", "station_id",
                                                   F.lit("nearest").alias("method"))
    return exact.unionByName(near)
