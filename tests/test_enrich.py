"""Weather enrichment of flights: nearest observation at both ends (J6 applied), the needed
station-months (J7) and the unit conversion (C11)."""
import datetime as dt

import pytest

from ontime_spark.operators import enrich


def test_attach_weather_nearest_both_ends(spark):
    flights = spark.createDataFrame(
        [(1, "ATL", "JFK", dt.date(2023, 1, 5), 1200), (2, "ATL", "ORD", dt.date(2023, 1, 5), 2359),
         (3, "SEA", "JFK", dt.date(2023, 1, 6), 800)],
        "flight_id long, origin string, dest string, fl_date date, crs_dep_time int")
    obs = spark.createDataFrame([
        ("ATL", dt.datetime(2023, 1, 5, 11, 51), 10, 5.0),
        ("ATL", dt.datetime(2023, 1, 5, 12, 20), 11, 7.0),
        ("ATL", dt.datetime(2023, 1, 5, 23, 40), 12, 9.0),
        ("JFK", dt.datetime(2023, 1, 5, 12, 0), 20, 15.0),
        ("JFK", dt.datetime(2023, 1, 6, 9, 30), 21, 25.0),
    ], "airport string, timestamp timestamp, obs_id long, wind_speed double")
    feats = obs.selectExpr("*", "10.0 AS visibility", "25000.0 AS ceiling", "60.0 AS temp",
                           "0.0 AS precip", "0 AS has_thunderstorm", "0 AS has_snow", "0 AS has_fog")
    out = {r["flight_id"]: r for r in enrich.attach_weather(flights, feats, "flight_id").collect()}
    assert out[1]["origin_wind_speed"] == 5.0 and out[1]["dest_wind_speed"] == 15.0
    assert out[2]["origin_wind_speed"] == 9.0 and out[2]["dest_wind_speed"] is None  # no ORD obs
    assert out[3]["origin_wind_speed"] is None and out[3]["dest_wind_speed"] is None  # 90 min away
    assert out[1]["origin_ceiling"] == 25000.0


def test_weather_for_needed_station_months(spark):
    flights = spark.createDataFrame([("ATL", dt.date(2023, 1, 5)), ("ATL", dt.date(2023, 1, 9)),
                                     ("BOS", dt.date(2023, 2, 1)), ("XXX", dt.date(2023, 1, 1))],
                                    "origin string, fl_date date")
    smap = spark.createDataFrame([("ATL", "722190-13874"), ("BOS", "725090-14739")],
                                 "iata string, station_id string")
    needed = enrich.needed_station_months(flights, smap, ["origin"])
    assert sorted((r["airport"], r["month"]) for r in needed.collect()) == [("ATL", 1), ("BOS", 2)]
    obs = spark.createDataFrame([("722190-13874", dt.datetime(2023, 1, 2, 0, 0)),
                                 ("722190-13874", dt.datetime(2023, 3, 2, 0, 0)),
                                 ("725090-14739", dt.datetime(2023, 2, 2, 0, 0))],
                                "station_id string, timestamp timestamp")
    got = sorted((r["airport"], r["timestamp"].month) for r in enrich.weather_for_flights(obs, needed).collect())
    assert got == [("ATL", 1), ("BOS", 2)]


def test_enrichment_covers_airports_seen_only_as_destination(spark):
    flights = spark.createDataFrame([(1, "ATL", "BOS", dt.date(2023, 1, 5), 1200)],
                                    "flight_id long, origin string, dest string, fl_date date, crs_dep_time int")
    smap = spark.createDataFrame([("ATL", "s1"), ("BOS", "s2"), ("SEA", "s3")], "iata string, station_id string")
    at = dt.datetime(2023, 1, 5, 12, 10)
    obs = spark.createDataFrame([(s, t, w, 0.0, 16093.44, 304.8, None) for s, t, w in (
        ("s1", at, 1.0), ("s2", at, 2.0), ("s3", at, 3.0), ("s2", dt.datetime(2023, 2, 5, 12, 0), 9.0))],
        "station_id string, timestamp timestamp, wind_speed_ms double, temp_c double, visibility_m double, "
        "ceiling_m double, precip_mm double")
    r = enrich.enrich_flights(flights, obs, smap, "flight_id").first()
    assert r["origin_wind_speed"] == pytest.approx(1.9438444924406)
    assert r["dest_wind_speed"] == pytest.approx(3.8876889848812) and r["dest_temp"] == pytest.approx(32.0)


def test_observations_are_ordered_over_all_partitions(spark):
    needed = spark.createDataFrame([(f"A{i}", 2023, 1, f"s{i}") for i in range(8)],
                                   "airport string, year int, month int, station_id string")
    obs = spark.createDataFrame([(f"s{i % 8}", dt.datetime(2023, 1, 1 + i % 28, i % 24, 0)) for i in range(400)],
                                "station_id string, timestamp timestamp")
    rows = [(r.airport, r.timestamp) for r in enrich.weather_for_flights(obs, needed).collect()]
    assert rows == sorted(rows) and len(rows) == 400


def test_observation_units(spark):
    obs = spark.createDataFrame([(10.0, 1609.344, 304.8, 100.0, None), (None, None, None, -40.0, 25.4)],
                                "wind_speed_ms double, visibility_m double, ceiling_m double, temp_c double, precip_mm double")
    rows = enrich.observation_features(obs).collect()
    assert rows[0]["wind_speed"] == pytest.approx(19.438444924406)
    assert rows[0]["visibility"] == pytest.approx(1.0) and rows[0]["ceiling"] == pytest.approx(1000.0)
    assert rows[0]["temp"] == pytest.approx(212.0) and rows[0]["precip"] == 0.0
    assert rows[1]["visibility"] == 10.0 and rows[1]["ceiling"] == 25000.0
    assert rows[1]["temp"] == pytest.approx(-40.0) and rows[1]["precip"] == pytest.approx(1.0)
