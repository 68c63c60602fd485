"""File sources: flights by suffix, BTS CSV, station inventory, ISD text, ADS-B JSON, and the
partitioned flight writer."""
import datetime as dt
import gzip
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from ontime_spark.operators import clean, featurizer
from ontime_spark.sources import adsb, bts, flights, isd, stations


def test_load_flights_by_suffix(spark, tmp_dir):
    p = os.path.join(tmp_dir, "f.csv")
    with open(p, "w") as fh:
        fh.write("fl_date,carrier,arr_delay\n2023-01-01,AA,5\n")
    assert flights.load_flights(spark, p).count() == 1
    pq = os.path.join(tmp_dir, "f.parquet")
    spark.createDataFrame([(1,)], "x int").write.parquet(pq)
    assert flights.load_flights(spark, pq).count() == 1
    with pytest.raises(ValueError):
        flights.load_flights(spark, os.path.join(tmp_dir, "f.json"))


def test_write_flights_splits_a_hot_date(spark, tmp_dir):
    hot = [(dt.date(2023, 5, 5), i) for i in range(4000)] + [(dt.date(2023, 5, 6), 1)]
    df = spark.createDataFrame(hot, "fl_date date, v int")
    out = os.path.join(tmp_dir, "hot")
    flights.write_flights(df, out, partitions=4)
    files = [f for f in os.listdir(os.path.join(out, "year=2023", "month=5")) if f.endswith(".parquet")]
    assert len(files) >= 3
    assert spark.read.parquet(out).count() == 4001


def test_write_flights_partitioned(spark, tmp_dir):
    rows = [(dt.date(2023, m, 1 + i), i) for m in (1, 2, 11) for i in range(3)]
    df = spark.createDataFrame(rows, "fl_date date, v int")
    out = os.path.join(tmp_dir, "flights")
    flights.write_flights(df, out)
    assert sorted(os.listdir(out))[:1] == ["_SUCCESS"] or "year=2023" in os.listdir(out)
    back = spark.read.parquet(out).where("month = 11")
    assert back.count() == 3
    _, test = featurizer.temporal_split(spark.read.parquet(out))
    assert test.count() == 3
    plan = test._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert re.search(r"month#\d+ IN \(11,12\)", filters), filters


def test_files_of_different_headers_are_united_by_name(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as fh:
        fh.write("FlightDate,Origin,Dest,Distance,\n2023-01-01,ATL,JFK,700,\n")
    with open(os.path.join(tmp_dir, "b.csv"), "w") as fh:
        fh.write("Dest,Origin,FlightDate\nLAX,ORD,2023-02-01\n")
    open(os.path.join(tmp_dir, "c.csv"), "w").close()
    rows = {r.source_file: r for r in bts.load_all_bts(spark, tmp_dir).collect()}
    assert set(rows) == {"a.csv", "b.csv"}
    assert (rows["a.csv"].Origin, rows["a.csv"].Dest, rows["a.csv"].Distance) == ("ATL", "JFK", 700.0)
    assert (rows["b.csv"].Origin, rows["b.csv"].Dest, rows["b.csv"].Distance) == ("ORD", "LAX", None)


def test_csv_flights_are_typed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "f.csv")
    with open(path, "w") as fh:
        fh.write("fl_date,carrier,crs_dep_time,arr_delay,cancelled,origin_has_snow\n"
                 "2023-01-01,AA,1200.0,5,0,\n2023-01-02,,930,,n/a,1\n2023-01-03,DL,x,NaN,0.0,0\n")
    df = flights.load_flights(spark, path)
    assert dict(df.dtypes)["crs_dep_time"] == "int" and dict(df.dtypes)["origin_has_snow"] in ("int", "tinyint")
    rows = df.orderBy("fl_date").collect()
    assert [r.crs_dep_time for r in rows] == [1200, 930, None] and [r.arr_delay for r in rows] == [5.0, None, None]
    out = clean.preprocess(df).orderBy("fl_date").collect()
    assert len(out) == 2 and [r.origin_has_snow for r in out] == [0.0, 0.0] and out[0].carrier == "AA"


BTS_HEADER = ",".join(["Year", "Month", "FlightDate", "Reporting_Airline", "Origin", "Dest",
                       "CRSDepTime", "ArrDelay", "Cancelled", "Distance"]) + ","


def _bts_file(path, rows):
    with open(path, "w") as fh:
        fh.write(BTS_HEADER + "\n")
        for r in rows:
            fh.write(",".join(r) + ",\n")


def test_load_bts_csv_trailing_comma_and_blanks(spark, tmp_dir):
    p = os.path.join(tmp_dir, "On_Time_Reporting_2023_1.csv")
    _bts_file(p, [["2023", "1", "2023-01-05", "AA ", " ATL", "LAX", "1205", "-3.00", "0.00", "1947.00"],
                  ["2023", "1", "2023-01-06", "DL", "ORD", "JFK", "0900", "", "1.00", "740.00"]])
    df = bts.load_bts_csv(spark, p)
    assert not [c for c in df.columns if c.startswith("_c")]
    r = df.orderBy("FlightDate").first()
    assert r["Reporting_Airline"] == "AA" and r["Origin"] == "ATL" and r["CRSDepTime"] == 1205
    assert r["ArrDelay"] == -3.0 and r["Year"] == 2023
    canon = bts.bts_to_canonical(df).orderBy("fl_date").collect()
    assert canon[0]["carrier"] == "AA" and canon[0]["fl_date"] == dt.date(2023, 1, 5)
    assert canon[1]["arr_delay"] is None and canon[1]["cancelled"] == 1


def test_load_all_bts_year_filter(spark, tmp_dir):
    for name in ("x_2022_1.csv", "x_2023_1.csv", "x_2023_2.csv"):
        _bts_file(os.path.join(tmp_dir, name), [["2023", "1", "2023-01-05", "AA", "ATL", "LAX", "1205", "1", "0", "1"]])
    df = bts.load_all_bts(spark, tmp_dir, 2023)
    assert df.count() == 2 and df.select("source_file").distinct().count() == 2
    with pytest.raises(FileNotFoundError):
        bts.load_all_bts(spark, tmp_dir, 1999)


def test_carrier_column_required(spark):
    with pytest.raises(KeyError):
        bts.bts_to_canonical(spark.createDataFrame([("ATL",)], "Origin string"))


def test_station_inventory_keeps_ids(spark, tmp_dir):
    p = os.path.join(tmp_dir, "isd-history.csv")
    with open(p, "w") as fh:
        fh.write('"USAF","WBAN","STATION NAME","CTRY","STATE","ICAO","LAT","LON","ELEV(M)","BEGIN","END"\n')
        fh.write('"007018","99999","WXPOD 7018","US","","KATL","+33.640","-084.427","+0010.0","20110309","20130730"\n')
        fh.write('"010010","00001","JAN MAYEN","NO","","","","","","19310101","20240101"\n')
    rows = stations.read_station_inventory(spark, p).orderBy("USAF").collect()
    assert rows[0]["USAF"] == "007018" and rows[0]["LAT"] == 33.64 and rows[1]["WBAN"] == "00001"
    assert rows[1]["LAT"] is None


def _isd_line(date="20230115", time="1350", wind="0051", ceil="22000", vis="016093",
              temp="+0123", dew="-0050"):
    line = ("0000" + "722190" + "13874" + date + time + " " * 33 + "18019" + wind + "1"
            + ceil + "19N" + vis + "1N9" + temp + "1" + dew + "1" + "101321")
    assert len(line) == 105
    return line


def test_isd_parse_file(spark, tmp_dir):
    lines = [_isd_line(),                                  # valid
             _isd_line()[:80],                             # too short
             _isd_line(wind="9999", ceil="99999", vis="999999", temp="+9999", dew="-9999"),
             _isd_line(temp="-0107"),                      # negative temperature
             _isd_line(vis="01A093"),                      # unparsable -> dropped
             _isd_line(date="20231345")]                   # invalid date -> dropped
    p = os.path.join(tmp_dir, "722190-13874-2023.gz")
    with gzip.open(p, "wt") as fh:
        fh.write("\n".join(lines) + "\n")
    obs = isd.read_isd(spark, p).orderBy(F.col("temp_c").asc_nulls_last()).collect()
    assert len(obs) == 3
    assert {r["station_id"] for r in obs} == {"722190-13874"} and obs[0]["file_year"] == 2023
    neg, ok = obs[0], obs[1]
    assert neg["temp_c"] == -10.7
    assert ok["temp_c"] == 12.3 and ok["dew_point_c"] == -5.0 and ok["wind_speed_ms"] == 5.1
    assert ok["ceiling_m"] == 22000.0 and ok["visibility_m"] == 16093.0
    assert ok["timestamp"] == dt.datetime(2023, 1, 15, 13, 50)
    missing = obs[2]
    assert missing["temp_c"] is None and missing["wind_speed_ms"] is None
    assert missing["ceiling_m"] is None and missing["visibility_m"] is None
    assert isd.filter_month(isd.read_isd(spark, p), 1).count() == 3


def test_isd_legacy_layout_drops_standard_lines(spark):
    df = spark.createDataFrame([(_isd_line(),)], "line string")
    assert isd.parse_isd_lines(df, layout="legacy").count() == 0
    assert isd.parse_isd_lines(df, layout="public").count() == 1


def test_adsb_json(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dep.json")
    recs = [{"icao24": "a1b2c3", "callsign": "DAL12 ", "estDepartureAirport": "KATL",
             "estArrivalAirport": "KJFK", "firstSeen": 1700000000, "lastSeen": 1700007200}]
    with open(p, "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in recs))
    r = adsb.read_adsb_json(spark, p).first()
    assert r["firstSeen"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert r["estArrivalAirport"] == "KJFK"
