"""Feature groups on the reference's preprocessed fixture (F2) and brute-force checks of the
airport features and encoders."""
import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ontime_spark import schemas as S
from ontime_spark.functions import temporal as TF
from ontime_spark.operators import clean, encoders as EN, features as FE, featurizer as FP

F2 = [(dt.date(2023, 7, 4), "AA", "ATL", "DFW", 800, 731, 5.0, 0, 12.0, 10.0, 25000, 85.0, 0.0, 0, 0, 0),
      (dt.date(2023, 11, 25), "UA", "ORD", "JFK", 1830, 740, 45.0, 0, 28.0, 2.0, 800, 32.0, 0.25, 0, 1, 1),
      (dt.date(2023, 12, 25), "DL", "LAX", "SFO", 2300, 337, -10.0, 0, 5.0, 8.0, 15000, 55.0, 0.0, 0, 0, 0)]
F2_SCHEMA = ("fl_date date, carrier string, origin string, dest string, crs_dep_time int, distance int, "
             "arr_delay double, cancelled int, origin_wind_speed double, origin_visibility double, "
             "origin_ceiling int, origin_temp double, origin_precip double, origin_has_thunderstorm int, "
             "origin_has_snow int, origin_has_fog int")


@pytest.fixture()
def f2(spark):
    return clean.add_delay_label(spark.createDataFrame(F2, F2_SCHEMA))


def test_temporal(f2):
    out = FE.add_temporal_features(f2, with_time_block=True).orderBy("fl_date").collect()
    assert out[0]["is_holiday"] == 1 and out[0]["hour_of_day"] == 8
    assert out[0]["day_of_week"] == 1  # Tuesday, 0 = Monday
    assert out[2]["is_holiday"] == 1 and out[1]["is_holiday"] == 0
    assert out[1]["time_block"] == "evening" and out[2]["time_block"] == "night"
    assert math.isclose(out[0]["hour_sin"], math.sin(2 * math.pi * 8 / 24))


def test_hour_2400_clips_to_23(spark):
    df = spark.createDataFrame([(2400,), (0,), (559,)], "t int")
    assert [r[0] for r in df.select(TF.hour_of_day("t")).collect()] == [23, 0, 5]


HOLIDAYS_2022_2023 = [
    "2022-01-17", "2022-02-21", "2022-05-30", "2022-06-20", "2022-07-04", "2022-09-05",
    "2022-10-10", "2022-11-11", "2022-11-24", "2022-12-26", "2022-12-25", "2022-06-19",
    "2022-01-01", "2021-12-31", "2023-01-01", "2023-01-02", "2023-01-16", "2023-02-20",
    "2023-05-29", "2023-06-19", "2023-07-04", "2023-09-04", "2023-10-09", "2023-11-10",
    "2023-11-11", "2023-11-23", "2023-12-25",
]


def test_holiday_calendar(spark):
    days = pd.date_range("2021-12-01", "2023-12-31").date
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {str(r[0]) for r in df.where(TF.is_holiday("d") == 1).collect()}
    assert got == set(HOLIDAYS_2022_2023) | {"2021-12-24", "2021-12-25"}


def test_near_holiday(spark):
    df = spark.createDataFrame([(dt.date(2023, 7, 3),), (dt.date(2023, 7, 5),), (dt.date(2023, 7, 7),)], "d date")
    assert [r[0] for r in df.select(TF.is_holiday("d", pad_days=1)).collect()] == [1, 1, 0]


def test_weather(f2):
    out = FE.add_weather_features(f2, extended=True).orderBy("fl_date").collect()
    assert out[1]["ifr_conditions_origin"] == 1 and out[1]["severe_weather_origin"] == 1
    assert out[2]["ifr_conditions_origin"] == 0 and out[2]["severe_weather_origin"] == 0
    assert out[1]["origin_wind_category"] == "strong" and out[0]["origin_wind_category"] == "moderate"
    assert out[0]["dest_visibility"] == 10.0 and out[0]["dest_ceiling"] == 25000  # defaults


def test_featurizer_fit_transform_has_every_feature(f2):
    out = FP.FlightFeaturizer().fit_transform(f2)
    assert out.columns == [S.TARGET_COL, *S.FEATURE_COLUMNS]
    assert out.count() == 3


def _flights(spark, rows):
    return spark.createDataFrame(rows, "origin string, dest string, fl_date date, crs_dep_time int, is_delayed int")


def _pandas_rolling(pdf, side, grid):
    daily = pdf.groupby([side, "fl_date"])["is_delayed"].mean().rename("r").reset_index()
    if grid == "dense":
        idx = pd.MultiIndex.from_product([sorted(pdf[side].unique()), sorted(pdf["fl_date"].unique())],
                                         names=[side, "fl_date"])
        daily = daily.set_index([side, "fl_date"]).reindex(idx).reset_index()
    daily = daily.sort_values([side, "fl_date"])
    daily["roll"] = daily.groupby(side)["r"].transform(lambda s: s.shift(1).rolling(7, min_periods=1).mean())
    return {(a, d): v for a, d, v in zip(daily[side], daily["fl_date"], daily["roll"])}


@pytest.mark.parametrize("grid", ["active", "dense"])
def test_rolling_rate_matches_pandas(spark, grid):
    import random
    rnd = random.Random(3)
    base = dt.date(2023, 3, 1)
    rows = [(rnd.choice("ABC"), rnd.choice("XY"), base + dt.timedelta(days=rnd.randrange(40)),
             rnd.choice([700, 800, 1300]), rnd.randrange(2)) for _ in range(400)]
    df = _flights(spark, rows)
    exp = _pandas_rolling(pd.DataFrame(rows, columns=df.columns), "origin", grid)
    got = FE.rolling_delay_rate(df, "origin", grid=grid).collect()
    for r in got:
        e = exp[(r["origin"], r["fl_date"])]
        if e is None or (isinstance(e, float) and math.isnan(e)):
            assert r["origin_delay_rate_rolling"] is None
        else:
            assert math.isclose(r["origin_delay_rate_rolling"], e, rel_tol=1e-12)


def test_airport_features_counts_and_missing_rate(spark):
    rows = [("A", "X", dt.date(2023, 1, 1), 800, 1), ("A", "Y", dt.date(2023, 1, 1), 830, 0),
            ("A", "X", dt.date(2023, 1, 2), 800, 0), ("B", "X", dt.date(2023, 1, 2), 900, 1)]
    df = FE.add_temporal_features(_flights(spark, rows))
    out = FE.add_airport_features(df, hubs=["A"]).orderBy("fl_date", "origin", "dest").collect()
    assert [r["origin_flights_per_hour"] for r in out] == [2, 2, 1, 1]
    assert [r["origin_delay_rate_rolling"] for r in out] == [0.0, 0.0, 0.5, 0.0]
    assert [r["is_origin_hub"] for r in out] == [1, 1, 1, 0]


def test_target_encoder_values_and_unseen(spark):
    rows = [("A", "B", "C1", 1)] * 3 + [("A", "B", "C2", 0)] + [("B", "A", "C1", 0)] * 4
    train = spark.createDataFrame(rows, "origin string, dest string, carrier string, is_delayed int")
    model = EN.TargetEncoder(smoothing=2).fit(train)
    g = 3 / 8
    test = spark.createDataFrame([("A", "B", "C1"), ("Z", "Z", "C9")], "origin string, dest string, carrier string")
    out = model.transform(test).orderBy("origin").collect()
    assert math.isclose(out[0]["route_avg_delay"], (4 * 0.75 + 2 * g) / 6)
    assert math.isclose(out[0]["carrier_delay_rate"], (7 * 3 / 7 + 2 * g) / 9)
    assert out[1]["route_avg_delay"] == pytest.approx(g) and out[1]["carrier_delay_rate"] == pytest.approx(g)


def test_target_encoder_save_load(spark, tmp_dir):
    rows = [("A", "B", "C1", 1), ("A", "B", "C2", 0)]
    df = spark.createDataFrame(rows, "origin string, dest string, carrier string, is_delayed int")
    m = EN.TargetEncoder().fit(df)
    m.save(tmp_dir)
    m2 = EN.TargetEncoderModel.load(spark, tmp_dir)
    assert m2.global_mean == m.global_mean
    assert sorted(m2.transform(df).select("route_avg_delay").collect()) == \
        sorted(m.transform(df).select("route_avg_delay").collect())


def test_ordinal_encoder_unseen_is_minus_one(spark):
    train = spark.createDataFrame([("UA", "ORD", "JFK"), ("AA", "ATL", "LAX")], "carrier string, origin string, dest string")
    test = spark.createDataFrame([("AA", "ATL", "SEA"), ("ZZ", "ORD", "JFK")], "carrier string, origin string, dest string")
    out = EN.OrdinalEncoder().fit(train).transform(test).orderBy("origin").collect()
    assert [tuple(r) for r in out] == [(0, 0, -1), (-1, 1, 0)]


def test_ordinal_encoder_bucketed_codes_are_sorted_ranks(spark):
    cats = [f"R{i:03d}" for i in range(57)]
    train = spark.createDataFrame([(c, c, c) for c in reversed(cats)] + [(None, "x", "y")],
                                  "carrier string, origin string, dest string")
    model = EN.OrdinalEncoder(["carrier"], rows_per_bucket=10).fit(train)
    got = {r["category"]: r["code"] for r in model.tables["carrier"].collect()}
    assert got == {c: i for i, c in enumerate(sorted(cats))}


def test_temporal_split_requires_date(spark):
    with pytest.raises(KeyError):
        FP.temporal_split(spark.createDataFrame([(1,)], "x int"))


def test_scoring_input_defaults(spark):
    out = FP.scoring_input(spark.createDataFrame([("DL",)], "carrier string")).first()
    assert out["carrier"] == "DL" and out["origin"] == "ATL" and out["dest_ceiling"] == 25000
    assert out["fl_date"] is not None


@pytest.mark.parametrize("grid", ["active", "dense"])
def test_airport_features_rolling_matches_pandas(spark, grid):
    import random
    rnd = random.Random(9)
    base = dt.date(2023, 3, 1)
    rows = [(rnd.choice("ABC"), rnd.choice("XYZ"), base + dt.timedelta(days=rnd.randrange(30)),
             rnd.choice([700, 800, 1300]), rnd.randrange(2)) for _ in range(300)]
    df = FE.add_temporal_features(_flights(spark, rows))
    out = FE.add_airport_features(df, grid=grid).collect()
    pdf = pd.DataFrame(rows, columns=["origin", "dest", "fl_date", "crs_dep_time", "is_delayed"])
    for side in ("origin", "dest"):
        exp = _pandas_rolling(pdf, side, grid)
        for r in out:
            e = exp[(r[side], r["fl_date"])]
            e = 0.0 if e is None or (isinstance(e, float) and math.isnan(e)) else e
            assert r[f"{side}_delay_rate_rolling"] == pytest.approx(e, abs=1e-12)


@pytest.mark.parametrize("grid", ["active", "dense"])
def test_future_flights_look_back_at_the_last_history_days(spark, grid):
    """Ten history days at A (rate 1 on the last three), a gap, then flights after the end."""
    day = dt.date(2023, 1, 1)
    hist = [(day + dt.timedelta(i), "A", "B", 1 if i >= 7 else 0) for i in range(10)]
    hist += [(day + dt.timedelta(12), "C", "B", 1)]
    history = spark.createDataFrame(hist, "fl_date date, origin string, dest string, is_delayed int")
    asked = [(day + dt.timedelta(d), o, "Z", 8) for d, o in ((30, "A"), (12, "A"), (9, "A"), (0, "A"), (30, "Q"), (400, "C"))]
    df = spark.createDataFrame(asked, "fl_date date, origin string, dest string, hour_of_day int")
    want = {(30, "A"): 3 / 7 if grid == "active" else 3 / 6, (12, "A"): 3 / 7, (9, "A"): 2 / 7, (0, "A"): 0.0,
            (30, "Q"): 0.0, (400, "C"): 1.0}
    for kw in ({"history": history}, {"rates": FE.airport_daily_rates(history)}):
        out = FE.add_airport_features(df, grid=grid, **kw).collect()
        got = {((r.fl_date - day).days, r.origin): r.origin_delay_rate_rolling for r in out}
        assert got == pytest.approx(want) and all(r.dest_delay_rate_rolling == 0.0 for r in out)


def test_featurizer_keeps_its_settings(spark, tmp_dir):
    rows = [(dt.date(2023, 1, 1 + i), "AA", "ATL", "JFK", 800, 500.0, i % 2) for i in range(9)]
    train = spark.createDataFrame(rows, "fl_date date, carrier string, origin string, dest string, "
                                        "crs_dep_time int, distance double, is_delayed int")
    model = FP.FlightFeaturizer(hubs=["JFK"], grid="dense", pad_days=1).fit(train)
    model.save(tmp_dir)
    back = FP.FlightFeaturizerModel.load(spark, tmp_dir)
    assert (back.hubs, back.grid, back.pad_days) == (["JFK"], "dense", 1)
    later = spark.createDataFrame([(dt.date(2023, 3, 1), "AA", "ATL", "JFK", 900, 500.0)], train.drop("is_delayed").schema)
    a, b = (m.transform(later).first().asDict() for m in (model, back))
    assert a == b and a["origin_delay_rate_rolling"] == pytest.approx(3 / 7)
    assert a["is_dest_hub"] == 1 and a["is_origin_hub"] == 0


def test_saved_medians_and_codes(spark, tmp_dir):
    train = spark.createDataFrame([("AA", 1.0), ("DL", None), (None, 3.0)], "carrier string, distance double")
    filler = clean.MissingValueFiller().fit(train)
    filler.save(spark, f"{tmp_dir}/filler")
    again = clean.MissingValueFiller.load(spark, f"{tmp_dir}/filler")
    assert again.transform(train).collect() == filler.transform(train).collect()
    codes = EN.OrdinalEncoder(["carrier"]).fit(train)
    codes.save(f"{tmp_dir}/codes")
    back = EN.OrdinalEncoderModel.load(spark, f"{tmp_dir}/codes", ["carrier"])
    assert sorted(back.transform(train).collect()) == sorted(codes.transform(train).collect())


def test_airport_group_reads_the_flights_twice(spark, tmp_dir):
    """One pass aggregates both ends, one is joined to: the airport-day table is a file."""
    rows = [(dt.date(2023, 1, 1 + i % 9), "ATL", "JFK", 8, i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "fl_date date, origin string, dest string, hour_of_day int, is_delayed int")
    df.write.parquet(f"{tmp_dir}/f")
    out = FE.add_airport_features(spark.read.parquet(f"{tmp_dir}/f"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    flights = [x for x in plan.split("\n") if "FileScan" in x and "is_delayed" in x]
    assert len(flights) == 1 and plan.count("FileScan") == 3 and "Generate" not in plan
