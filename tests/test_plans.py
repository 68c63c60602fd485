"""End-to-end jobs on the sf0.001 driver tables: training (L8), batch scoring with
explanations (L9) and its micro-batch form."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ontime_spark import schemas as S
from ontime_spark.operators import clean, featurizer as FP, models as M
from ontime_spark.plans.score import score_job
from ontime_spark.plans.train import train_job
from ontime_spark.sources import driver


@pytest.fixture(scope="module")
def trained(spark):
    import tempfile
    models_dir = tempfile.mkdtemp(prefix="models-", dir="/tmp")
    flights = driver.flights(spark, SF_SMALL)
    results, comparison = train_job(flights, models_dir, hubs=driver.DRIVER_HUBS,
                                    rf_trees=5, gbt_rounds=5)
    return flights, models_dir, results, comparison


def test_train_job(trained):
    _, models_dir, results, comparison = trained
    assert set(results) == {"lr", "rf", "xgboost"}
    rows = comparison.collect()
    assert [r["pr_auc"] for r in rows] == sorted((r["pr_auc"] for r in rows), reverse=True)
    for r in rows:
        assert all(0.0 <= r[k] <= 1.0 for k in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"))
    assert set(M.load_all_models(comparison.sparkSession, models_dir)) == {"lr", "rf", "xgboost"}


def test_train_job_rejects_unknown_type(spark):
    with pytest.raises(ValueError):
        train_job(driver.flights(spark, SF_SMALL), model_types=("svm",))


@pytest.mark.parametrize("model_type", ["lr", "rf"])
def test_score_job_explains(spark, trained, model_type):
    flights, models_dir, results, _ = trained
    fz = FP.FlightFeaturizerModel.load(spark, os.path.join(models_dir, "featurizer"))
    history = clean.preprocess(flights)
    upcoming = flights.select("l_orderkey", "fl_date", "carrier", "origin", "dest",
                              "crs_dep_time", "distance").limit(20)
    out = score_job(upcoming, fz, history, results[model_type]["model"], model_type, top_n=8,
                    keep=("l_orderkey",))
    rows = out.select("probability_delayed", "risk_band", "explanation", "top_contribs",
                      "raw_margin", "base_value", "contribs").collect()
    assert len(rows) == 20
    for r in rows:
        assert len(r["top_contribs"]) == 8
        assert r["explanation"].startswith("This flight is likely")
        assert r["risk_band"] in ("ON TIME", "MODERATE DELAY RISK", "HIGH DELAY RISK")
        total = r["base_value"] + sum(c["value"] for c in r["contribs"])
        assert total == pytest.approx(r["raw_margin"])


def test_scoring_stream(spark, trained, tmp_dir):
    from ontime_spark.streaming.scoring import start_scoring_stream
    flights, models_dir, results, _ = trained
    fz = FP.FlightFeaturizerModel.load(spark, os.path.join(models_dir, "featurizer"))
    src = os.path.join(tmp_dir, "incoming")
    upcoming = flights.select("l_orderkey", "fl_date", "carrier", "origin", "dest", "crs_dep_time")
    upcoming.limit(30).write.parquet(src)
    q = start_scoring_stream(spark, src, upcoming.schema, fz, clean.preprocess(flights),
                             results["lr"]["model"], os.path.join(tmp_dir, "scored"),
                             checkpoint_location=os.path.join(tmp_dir, "ckpt"),
                             available_now=True, keep=("l_orderkey",))
    q.awaitTermination(300)
    out = spark.read.parquet(os.path.join(tmp_dir, "scored"))
    assert out.count() == 30 and "explanation" in out.columns
