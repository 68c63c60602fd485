"""Registered queries do their whole job: every row, and the published settings."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from ontime_spark import registry
from ontime_spark.operators import clean
from ontime_spark.operators import models as M
from ontime_spark.plans import train
from ontime_spark.sources import driver


def test_beeswarm_counts_every_flight(spark):
    flights = clean.filter_cancelled(driver.flights(spark, SF_SMALL)).count()
    out = registry.QUERIES["m14_beeswarm"](spark, SF_SMALL).groupBy("feature").agg(F.sum("n").alias("n")).collect()
    assert {r["feature"]: r["n"] for r in out} == dict.fromkeys(registry.BOOSTED, flights)


def test_training_job_has_the_published_settings(spark, monkeypatch):
    class Stop(Exception):
        pass

    asked = {}

    def fitted(table, model_type, **kw):
        asked[model_type] = kw
        if len(asked) == len(M.MODEL_TYPES):
            raise Stop
        return None

    monkeypatch.setattr(train.M, "train_model", fitted)
    monkeypatch.setattr(train, "evaluate_model", lambda *a, **b: spark.range(1))
    monkeypatch.setattr(train.M, "save_model", lambda model, path: path)
    with pytest.raises(Stop):
        registry.QUERIES["l8_l9_train_compare_score"](spark, SF_SMALL)
    assert asked == {"lr": {}, "rf": {}, "xgboost": {}}
    assert (M.RF_TREES, M.GBT_ROUNDS) == (300, 500)
