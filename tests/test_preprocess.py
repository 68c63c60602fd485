"""Cleaning steps on the reference's raw-flight fixture (F1) plus the edge cases it skips."""
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from ontime_spark import schemas as S
from ontime_spark.operators import clean

RAW = [("2023-01-01", "AA", "ATL", "LAX", 1200, 5.0, 0, 1947, 12.5),
       ("2023-01-02", "DL", "ORD", "DFW", 1530, 45.0, 0, 731, None),
       ("2023-01-03", "UA", "JFK", "SFO", 900, None, 1, 2586, 8.0)]
SCHEMA = ("fl_date string, carrier string, origin string, dest string, crs_dep_time int, "
          "arr_delay double, cancelled int, distance int, origin_wind_speed double")


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(RAW, SCHEMA)


def test_cast_types(raw):
    t = {f.name: f.dataType for f in clean.cast_types(raw).schema.fields}
    assert isinstance(t["fl_date"], T.DateType)
    assert isinstance(t["carrier"], T.StringType) and isinstance(t["origin"], T.StringType)
    assert isinstance(t["arr_delay"], T.DoubleType)
    assert isinstance(t["distance"], T.DoubleType)
    assert isinstance(t["crs_dep_time"], T.IntegerType)


def test_cast_bad_values_become_null(spark):
    df = spark.createDataFrame([("2023-13-45", "x12", "7")], "fl_date string, arr_delay string, distance string")
    r = clean.cast_types(df).first()
    assert r["fl_date"] is None and r["arr_delay"] is None and r["distance"] == 7.0


def test_filter_cancelled(raw):
    out = clean.filter_cancelled(raw).collect()
    assert len(out) == 2 and all(r["cancelled"] == 0 for r in out)


def test_filter_cancelled_null_counts_as_cancelled(spark):
    df = spark.createDataFrame([(0,), (None,), (1,)], "cancelled int")
    assert clean.filter_cancelled(df).count() == 1


def test_cancelled_counts(raw):
    r = clean.cancelled_counts(raw).first()
    assert (r["n_before"], r["n_removed"]) == (3, 1)
    assert r["pct_removed"] == pytest.approx(100 / 3)


def test_create_delay_target(raw):
    out = clean.add_delay_label(raw.dropna(subset=["arr_delay"])).orderBy("fl_date").collect()
    assert out[0]["is_delayed"] == 0 and out[1]["is_delayed"] == 1


def test_missing_delay_is_label_zero(raw):
    r = clean.add_delay_label(raw).where("arr_delay IS NULL").first()
    assert r["is_delayed"] == 0


def test_label_requires_arr_delay(spark):
    with pytest.raises(KeyError):
        clean.add_delay_label(spark.createDataFrame([(1,)], "x int"))


def test_handle_missing_median(raw):
    out = clean.fill_missing(raw).orderBy("fl_date").collect()
    assert all(r["arr_delay"] is not None for r in out)
    assert out[1]["origin_wind_speed"] == float(np.nanmedian([12.5, np.nan, 8.0])) == 10.25


def test_unknown_fill_for_strings(spark):
    df = spark.createDataFrame([("AA",), (None,)], "carrier string")
    assert sorted(r[0] for r in clean.fill_missing(df).collect()) == ["AA", "UNKNOWN"]


@pytest.mark.parametrize("skewed,bucketed", [(False, False), (True, False), (True, True)])
def test_exact_median_matches_numpy(spark, skewed, bucketed, monkeypatch):
    from ontime_spark.operators import cumulative
    if bucketed:  # force the bucketed plan
        monkeypatch.setattr(cumulative, "ROWS_PER_BUCKET", 150)
    rng = np.random.default_rng(7)
    vals = rng.normal(size=2001).round(3)
    if skewed:  # a third of the rows on one value
        vals[:700] = 1.5
    rows = [(float(v) if i % 10 else None, float(v) * 2) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "a double, b double")
    med = clean.column_medians(df, ["a", "b"])
    a = np.array([r[0] for r in rows if r[0] is not None])
    assert math.isclose(med["a"], float(np.median(a)), abs_tol=1e-12)
    assert math.isclose(med["b"], float(np.median(vals * 2)), abs_tol=1e-12)


def test_preprocess_order_label_before_fill(raw):
    out = clean.preprocess(raw).collect()
    assert len(out) == 2
    assert all(r["arr_delay"] is not None for r in out)


def test_profile(raw):
    r = clean.profile(clean.cast_types(raw)).first()
    assert r["n_rows"] == 3 and str(r["min_date"]) == "2023-01-01"


def test_nan_is_a_missing_value(spark, tmp_dir):
    """From Parquet and from CSV: null after the casts, label 0, counted, filled, in no median."""
    nan = float("nan")
    f = spark.createDataFrame([("2023-01-01", nan, 8.0, 0), ("2023-01-02", 45.0, nan, 0), ("2023-01-03", 5.0, 12.5, 0), ("2023-01-04", None, None, 0)],
                              "fl_date string, arr_delay double, origin_wind_speed double, cancelled int")
    f.write.parquet(f"{tmp_dir}/f.parquet")
    f.write.option("header", True).csv(f"{tmp_dir}/f.csv")
    for df in (spark.read.parquet(f"{tmp_dir}/f.parquet"), spark.read.option("header", True).csv(f"{tmp_dir}/f.csv")):
        out = clean.cast_types(df).orderBy("fl_date").collect()
        assert [r["arr_delay"] for r in out] == [None, 45.0, 5.0, None] and [r["origin_wind_speed"] for r in out] == [8.0, None, 12.5, None]
    assert [r[S.TARGET_COL] for r in clean.add_delay_label(f).orderBy("fl_date").collect()] == [0, 1, 0, 0]
    assert clean.missing_counts(f, ["arr_delay", "origin_wind_speed"]).first().asDict() == {"arr_delay": 2, "origin_wind_speed": 2}
    prof = {r["column"]: (r["n_missing"], r["median"]) for r in clean.missing_profile(f, ["arr_delay", "origin_wind_speed"]).collect()}
    assert prof == {"arr_delay": (2, 25.0), "origin_wind_speed": (2, 10.25)}
    filled = clean.fill_missing(f).orderBy("fl_date").collect()
    assert [r["origin_wind_speed"] for r in filled] == [8.0, 10.25, 12.5, 10.25]
