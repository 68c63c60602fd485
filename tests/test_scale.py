"""What keeps the flight queries' cost in step with their input: plans, compiled stages, block tables."""
import math

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL

from ontime_spark import registry
from ontime_spark.operators import boosting, clean
from ontime_spark.operators import explain as XP
from ontime_spark.sources import driver
from ontime_spark.sources import flights as FL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_items_are_exchanged_once(spark):
    plan = _plan(driver.flights(spark, SF_SMALL))
    assert "RoundRobinPartitioning" not in plan
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "lineitem.parquet" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, at = 0, depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            at = depth(line)
            above += "Exchange hashpartitioning" in line
    assert above == 1


def test_wide_stages_are_compiled(spark, tmp_dir):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "65535")
    try:
        df = driver.flights(spark, SF_SMALL)
        assert df.sparkSession.conf.get(key) == "8000" and spark.conf.get(key) == "65535"
        assert df.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
        spark.range(3).select(F.lit("2023-01-02").alias("fl_date")).write.option("header", True).csv(f"{tmp_dir}/a.csv")
        assert FL.load_flights(spark, f"{tmp_dir}/a.csv").sparkSession.conf.get(key) == "8000"
    finally:
        spark.conf.set(key, before)


def test_rounding_without_decimals(spark):
    x = [0.0, -0.0, 1.5, 2.5e-6, 1.0000005, 0.0000005, -0.0000005, 0.07 * 500, 1e-9, -1e-9, 123456.7890125, 1e8 + 0.1234565, 1e15, -3.3e20,
         5e-324, math.inf, -math.inf, math.nan, None, *np.random.default_rng(7).normal(0, 1000, 2000).tolist(),
         *(np.arange(-500, 500) * 1e-6 + 0.5e-6).tolist()]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    for digits in (4, 6):
        rows = df.select(F.round("x", digits).alias("a"), registry.rounded_number("x", digits).alias("b")).collect()
        assert [str(r["a"]) for r in rows] == [str(r["b"]) for r in rows]
    assert "CASE WHEN" in _plan(registry.rounded(df))


def test_fill_reads_the_input_once(spark):
    assert "lineitem" not in _plan(registry.QUERIES["p4_fill_missing"](spark, SF_SMALL))
    df = spark.createDataFrame([(1.0, None), (None, "a"), (3.0, "b")], "x double, s string")
    filled = clean.fill_missing(df, materialize=True)
    assert sorted(map(tuple, filled.collect())) == sorted(map(tuple, clean.fill_missing(df).collect())) == [(1.0, "UNKNOWN"), (2.0, "a"), (3.0, "b")]


def test_global_importance_by_place(spark):
    df = spark.createDataFrame([(1.0, -2.0), (-3.0, 0.5), (None, 4.0)], "a double, b double")
    df = XP.linear_contributions(df, ["a", "b"], [2.0, 1.0], 0.0)
    by_place, by_row = XP.global_importance(df, features=["a", "b"]), XP.global_importance(df)
    assert [tuple(r) for r in by_place.collect()] == [tuple(r) for r in by_row.collect()]
    assert XP.global_importance(df.limit(0), features=["a", "b"]).count() == 0
    # The rows themselves are aggregated, not a row per feature of each.
    plan = _plan(by_place)
    assert plan.index("Generate") < plan.index("HashAggregate")


def test_binned_table_holds_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(float(rng.integers(2)), None if rng.random() < 0.1 else float(rng.integers(9)), float(rng.normal())) for _ in range(500)]
    df = spark.createDataFrame(rows, "y double, a double, b double").coalesce(2)
    cuts = boosting.bin_cuts(df, ["a", "b"], 255)
    blocks = boosting._binned(df, ["a", "b"], "y", cuts, 0.25).collect()
    assert len(blocks) < 10 and sum(len(b["y"]) for b in blocks) == 8 * len(rows)
    bins = np.concatenate([np.frombuffer(b["bins"], np.uint8).reshape(-1, 2) for b in blocks])
    want = [[0 if r[1] is None else 1 + sum(r[1] > c for c in cuts[0]), 1 + sum(r[2] > c for c in cuts[1])] for r in rows]
    assert bins.tolist() == want


def test_rows_end_where_a_plain_walk_ends():
    tree = boosting.Tree()
    tree.add(0.0, 0.0, 0)
    for node, feature, at, missing in ((0, 1, 3, True), (1, 0, 2, False), (2, 0, 200, True)):
        tree.feature[node], tree.bin[node], tree.missing_left[node] = feature, at, missing
        tree.left[node] = tree.add(0.0, 0.0, 2 * tree.place[node] + 1)
        tree.right[node] = tree.add(0.0, 0.0, 2 * tree.place[node] + 2)
    bins = np.array([(a, b) for a in (0, 1, 2, 3, 200, 255) for b in (0, 1, 3, 4, 255)], np.uint8)

    def walk(row):
        node = 0
        while tree.left[node] >= 0:
            b = row[tree.feature[node]]
            left = tree.missing_left[node] if b == 0 else b <= tree.bin[node]
            node = tree.left[node] if left else tree.right[node]
        return node

    found = boosting._by_bins(tree.arrays(), bins, 6)
    assert found.tolist() == [walk(r) for r in bins.tolist()]


def test_tables_are_read_in_small_parts(spark):
    from ontime_spark import session
    whole = spark.range(10).coalesce(1)
    assert len(session.materialize(whole, "whole").inputFiles()) == 1
    parts = session.materialize(whole, "parts", 3)
    assert len(parts.inputFiles()) == 4
    assert sorted(r["id"] for r in parts.collect()) == list(range(10))
    key = "spark.sql.files.maxPartitionBytes"
    other = spark.newSession()
    assert session.wide_session(other).conf.get(key) == str(session.SPLIT_BYTES)
    other.conf.set(key, "5m")
    assert session.wide_session(other).conf.get(key) == "5m"


def _some_flights(spark):
    rows = [(f"2023-{1 + i % 12:02d}-{1 + i % 27:02d}", f"C{i % 3}", f"A{i % 4}", f"A{(i + 1) % 4}", 600 + i % 9 * 100,
             300 + i % 5, None if i % 11 == 0 else float(i * 7 % 40), int(i % 13 == 0)) for i in range(240)]
    return spark.createDataFrame(rows, "fl_date string, carrier string, origin string, dest string, crs_dep_time int, "
                                       "distance int, arr_delay double, cancelled int")


def test_shared_steps_of_the_matrices_run_once(spark, monkeypatch):
    """The given preprocessed flights are used as they are, and both matrices look back on one table of rates."""
    from ontime_spark.operators import features as FE
    from ontime_spark.plans import train
    flights = _some_flights(spark)
    expected = [sorted(map(tuple, m.collect())) for m in train.prepare_matrices(flights)[:2]]
    pre = clean.preprocess(flights)
    made, rates = [], FE.airport_daily_rates
    monkeypatch.setattr(train.clean, "preprocess", None)
    monkeypatch.setattr(FE, "airport_daily_rates", lambda df, *a: made.append(len(df.columns) == len(pre.columns)) or rates(df, *a))
    matrices = train.prepare_matrices(pre, preprocessed=True)[:2]
    assert made.count(True) == 1
    assert [sorted(map(tuple, m.collect())) for m in matrices] == expected
    assert len(expected[0]) and len(expected[1])
