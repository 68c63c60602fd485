"""Joins the reference never tested, checked against brute force: as-of, station mapping,
bounding-box counts, running totals."""
import datetime as dt
import math
import random

import pandas as pd
import pytest

from pyspark.sql import functions as F

from ontime_spark.operators import adsb, asof, cumulative, stations


def _brute_asof(left, right, tol, direction):
    out = {}
    for lid, lk, lt in left:
        best = None
        for rid, rk, rt, v in right:
            dt = rt - lt
            if rk != lk or abs(dt) > tol:
                continue
            if direction == "backward" and dt > 0 or direction == "forward" and dt < 0:
                continue
            key = (abs(dt), rt, rid)
            if best is None or key < best[0]:
                best = (key, rid)
        out[lid] = best[1] if best else None
    return out


@pytest.mark.parametrize("direction,per_bucket", [
    ("nearest", None), ("backward", None), ("forward", None),
    ("nearest", 40), ("backward", 40), ("forward", 40)])
def test_asof_matches_brute_force(spark, direction, per_bucket):
    rnd = random.Random(5)
    base = 1_700_000_000
    left = [(i, rnd.choice("AB"), base + rnd.randrange(20000)) for i in range(300)]
    right = [(1000 + i, rnd.choice("AB"), base + rnd.randrange(0, 20000, 30), rnd.random()) for i in range(150)]
    ldf = spark.createDataFrame([(i, k, (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=t))) for i, k, t in left], "lid long, k string, t timestamp")
    rdf = spark.createDataFrame([(i, k, (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=t)), v) for i, k, t, v in right],
                                "rid long, k string, t2 timestamp, v double")
    out = asof.asof_join(ldf, rdf, "k", "t", "t2", "lid", "rid", 600, direction, right_cols=["rid", "v"],
                         rows_per_bucket=per_bucket)
    got = {r["lid"]: r["rid"] for r in out.collect()}
    assert got == _brute_asof(left, right, 600, direction)


def test_station_mapping_matches_brute_force(spark):
    rnd = random.Random(11)
    st = [(f"{700000 + i:06d}", f"{i * 7 % 100000:05d}", "US" if i % 9 else "CA",
           f"K{i % 30}" if i % 4 == 0 else None,
           None if i % 13 == 0 else 20 + rnd.random() * 30, -125 + rnd.random() * 60) for i in range(300)]
    ap = [(f"A{k}", f"k{k}", 22 + k * 0.7, -120 + k * 1.3) for k in range(40)]
    sdf = spark.createDataFrame(st, "USAF string, WBAN string, CTRY string, ICAO string, LAT double, LON double")
    adf = spark.createDataFrame(ap, "iata string, icao string, lat double, lon double")
    got = {r["iata"]: (r["station_id"], r["method"]) for r in stations.map_airports_to_stations(adf, sdf).collect()}
    us = [s for s in st if s[2] == "US" and s[4] is not None and s[5] is not None]
    for iata, icao, lat, lon in ap:
        exact = sorted((s[0], s[1]) for s in us if s[3] == icao.upper())
        if exact:
            assert got[iata] == (f"{exact[0][0]}-{exact[0][1]}", "icao")
        else:
            best = min(us, key=lambda s: ((s[4] - lat) * (s[4] - lat) + (s[5] - lon) * (s[5] - lon), s[0], s[1]))
            assert got[iata] == (f"{best[0]}-{best[1]}", "nearest")


def test_bbox_counts_match_brute_force(spark):
    rnd = random.Random(2)
    states = [(i, 30 + rnd.random() * 10, -100 + rnd.random() * 10) for i in range(2000)]
    aps = [("K1", 32.0, -95.0), ("K2", 35.5, -92.25), ("K3", None, None), ("K4", 39.99, -90.01)]
    sdf = spark.createDataFrame(states, "state_id long, lat double, lon double")
    adf = spark.createDataFrame(aps, "icao string, lat double, lon double")
    got = {r["icao"]: r["n_aircraft"] for r in adsb.aircraft_near_airports(sdf, adf, 0.5).collect()}
    for icao, la, lo in aps:
        exp = 0 if la is None else sum(1 for _, a, b in states if la - 0.5 <= a <= la + 0.5 and lo - 0.5 <= b <= lo + 0.5)
        assert got[icao] == exp


@pytest.mark.parametrize("descending,limit", [(False, 100), (True, 100), (True, 10_000)])
def test_running_totals_match_cumsum(spark, descending, limit):
    rnd = random.Random(4)
    rows = [(g, float(x), rnd.randrange(5)) for g in "ab" for x in rnd.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "g string, x double, n long")
    got = {(r["g"], r["x"]): r["cum_n"] for r in cumulative.running_totals(
        df, ["g"], "x", ["n"], descending, rows_per_bucket=limit).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "x", "n"]).sort_values(["g", "x"], ascending=[True, not descending])
    pdf["c"] = pdf.groupby("g")["n"].cumsum()
    for g, x, c in zip(pdf["g"], pdf["x"], pdf["c"]):
        assert got[(g, x)] == c


def test_asof_hot_key_is_linear(spark):
    """One key with all rows in one hour: the scan keeps one row per input row (no candidate
    pairs) and the hot key is spread over several range buckets."""
    import datetime as _dt
    t0 = _dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(i, "HOT", t0 + _dt.timedelta(seconds=i)) for i in range(400)],
                                 "lid long, k string, t timestamp")
    right = spark.createDataFrame([(i, "HOT", t0 + _dt.timedelta(seconds=i + 0.5), float(i))
                                   for i in range(400)], "rid long, k string, t2 timestamp, v double")
    out = asof.asof_join(left, right, "k", "t", "t2", "lid", "rid", 3600, "backward",
                         right_cols=["rid"], rows_per_bucket=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    got = {r["lid"]: r["rid"] for r in out.collect()}
    assert got == {i: (i - 1 if i > 0 else None) for i in range(400)}


@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
def test_asof_equal_time_ties_match_brute_force(spark, direction):
    """Observations sharing a time (smallest id wins), departures exactly at an observation
    time, and equal distance on both sides (the earlier one wins), over several buckets."""
    base = 1_700_000_000
    left = [(i, "A", base + 60 * (i % 20) + (30 if i % 3 == 0 else 0)) for i in range(60)]
    right = [(100 + i, "A", base + 60 * (i % 15), float(i)) for i in range(45)]
    ldf = spark.createDataFrame([(i, k, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=t))
                                 for i, k, t in left], "lid long, k string, t timestamp")
    rdf = spark.createDataFrame([(i, k, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=t), v)
                                 for i, k, t, v in right], "rid long, k string, t2 timestamp, v double")
    out = asof.asof_join(ldf, rdf, "k", "t", "t2", "lid", "rid", 45, direction,
                         right_cols=["rid", "v"], rows_per_bucket=12)
    got = {r["lid"]: r["rid"] for r in out.collect()}
    assert got == _brute_asof(left, [(i, k, t, v) for i, k, t, v in right], 45, direction)


def test_rows_of_one_key_and_time_are_split_over_buckets(spark, monkeypatch):
    seen = []
    keep = asof.materialize
    monkeypatch.setattr(asof, "materialize", lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1])
    left = spark.range(4000).select(F.lit("A").alias("g"), F.lit("2023-01-01 10:00:00").cast("timestamp").alias("t"),
                                    F.col("id").alias("lid"))
    right = spark.createDataFrame([("A", "2023-01-01 09:50:00", 1), ("A", "2023-01-01 10:00:00", 2),
                                   ("A", "2023-01-01 10:05:00", 3)], "g string, u string, rid int").withColumn(
        "u", F.col("u").cast("timestamp"))
    out = asof.asof_join(left, right, "g", "t", "u", "lid", "rid", 3600, right_cols=["rid"], rows_per_bucket=100)
    assert {r.rid for r in out.select("rid").distinct().collect()} == {2} and out.count() == 4000
    buckets = next(df for name, df in seen if name == "asof-buckets")
    assert max(r["count"] for r in buckets.groupBy("_bucket").count().collect()) < 1000


def test_assembled_matrix(spark):
    from ontime_spark.operators import featurizer as FP
    df = spark.createDataFrame([(1.0, None, 1), (2.0, 3.0, 0)], "hour_of_day double, month double, is_delayed int")
    rows = FP.assemble(df, ["hour_of_day", "month", "absent"]).select("features", "label").collect()
    assert [r.label for r in rows] == [1.0, 0.0] and len(rows[0].features) == 2
    assert [r.label for r in FP.assemble(df.drop("is_delayed"), ["hour_of_day"]).collect()] == [0.0, 0.0]
