"""Profiles without a scan, snapshots with zeros, and the summary plot's cells."""
import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from ontime_spark.operators import adsb, clean, explain


def test_footer_profile_reads_no_column(spark, tmp_dir):
    df = spark.range(5000).select((F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 90).cast("int"))).alias("fl_date"),
                                  F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("a"), F.lit(None).cast("double").alias("b"),
                                  (F.col("id") % 3).alias("part"))
    df.write.partitionBy("part").parquet(f"{tmp_dir}/t.parquet")
    out = clean.footer_profile(spark, f"{tmp_dir}/t.parquet", ["a", "b"])
    assert tuple(out.first()) == (5000, dt.date(2023, 1, 1), dt.date(2023, 3, 31), 500, 5000)
    plan = out._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "COUNT(a)" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_snapshots_include_zeros(spark):
    states = spark.createDataFrame([(0, 10.1, 20.1), (59, 10.2, 20.0), (61, 10.0, 20.0), (3600, 0.0, 0.0), (61, None, 20.0)], "time long, lat double, lon double")
    airports = spark.createDataFrame([("A", 10.0, 20.0), ("B", 50.0, 20.0), ("C", None, None)], "icao string, lat double, lon double")
    got = {(r["icao"], r["time"]): r["n_aircraft"] for r in adsb.aircraft_per_snapshot(states, airports, 0.5, "icao", 60).collect()}
    assert got == {(k, t): 0 for k in "ABC" for t in (0, 60, 3600)} | {("A", 0): 2, ("A", 60): 1}


def test_beeswarm_cells(spark):
    rows = [(float(i % 40), None if i % 9 == 0 else i / 7, [("a", (i % 40) * 0.5), ("b", -i / 3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, contribs array<struct<feature: string, value: double>>")
    out = explain.beeswarm(df, ["a", "b"], bins=4).collect()
    edges = {}
    for k, f in enumerate("ab"):
        for j, pick in enumerate((lambda r: r[k], lambda r: round(r[2][k][1], 9))):
            v = sorted(x for x in map(pick, rows) if x is not None)
            edges[f, j] = [v[-(-len(v) * q // 4) - 1] for q in (1, 2, 3)]
    want = Counter()
    for r in rows:
        for k, f in enumerate("ab"):
            bins = [None if x is None else sum(x > e for e in edges[f, j]) for j, x in enumerate((r[k], round(r[2][k][1], 9)))]
            want[f, *bins] += 1
    assert Counter({(r["feature"], r["value_bin"], r["contrib_bin"]): r["n"] for r in out}) == want
    assert len(out) <= 2 * 5 * 4
