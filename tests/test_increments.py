"""State that can be added to: merged parts equal a fit on all; late flights touch only their months."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ontime_spark.operators import features as FE
from ontime_spark.operators import increments as I
from ontime_spark.operators.encoders import TargetEncoder


def flights(spark, n=400, start=0):
    rows = [(dt.date(2023, 1 + i % 5, 1 + i % 9) if i % 50 else None, f"C{i % 3}", f"A{i % 4}" if i % 41 else None, f"B{i * 7 % 5}",
             None if i % 37 == 0 else int(i * 13 % 7 < 3)) for i in range(start, start + n)]
    return spark.createDataFrame(rows, "fl_date date, carrier string, origin string, dest string, is_delayed int")


def rows_of(df):
    return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()], key=str)


def test_merged_states_equal_a_fit_on_all(spark, tmp_dir):
    a, b = flights(spark), flights(spark, 300, 1000)
    whole = TargetEncoder().fit(a.union(b))
    for state in (I.merged(I.encoder_state(a), I.encoder_state(b)),
                  I.load(spark, I.upsert(spark, I.encoder_state(b), I.upsert(spark, I.encoder_state(a), f"{tmp_dir}/enc")))):
        model = I.encoder_of(state)
        assert abs(model.global_mean - whole.global_mean) < 1e-12
        assert rows_of(model.transform(a).select("route_avg_delay", "carrier_delay_rate")) == rows_of(
            whole.transform(a).select("route_avg_delay", "carrier_delay_rate"))


@pytest.mark.parametrize("side", ["origin", "dest"])
def test_daily_rates_with_late_flights(spark, tmp_dir, side):
    a, b = flights(spark), flights(spark, 90, 2000)
    path = f"{tmp_dir}/days"
    for part in (a, b, a.limit(0)):
        I.upsert(spark, I.airport_day_state(part), path)
    assert rows_of(I.daily_rates(I.load(spark, path), side)) == rows_of(
        FE.daily_delay_rate(a.union(b), side).select(side, "fl_date", "daily_rate"))


def test_only_the_months_of_late_flights_are_rewritten(spark, tmp_dir):
    path = I.upsert(spark, I.airport_day_state(flights(spark)), f"{tmp_dir}/days")
    files = lambda: {m: sorted(os.listdir(f"{path}/{m}")) for m in os.listdir(path) if m.startswith("month_key=")}
    before = files()
    I.upsert(spark, I.airport_day_state(flights(spark).where(F.month("fl_date") == 3)), path)
    after = files()
    assert {m for m in after if after[m] != before[m]} == {"month_key=2023-03"}
