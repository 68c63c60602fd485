"""Classifiers on the reference's model-matrix fixture (F3): 100 rows, 10 standard-normal
features, label P(1) = 0.3."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime_spark.operators import models as M
from ontime_spark.plans.train import evaluate_model

COLS = [f"feature_{i}" for i in range(10)]


@pytest.fixture(scope="module")
def matrix(spark):
    np.random.seed(42)
    X = np.random.randn(100, 10)
    y = np.random.choice([0, 1], size=100, p=[0.7, 0.3])
    rows = [tuple(float(v) for v in x) + (int(t),) for x, t in zip(X, y)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLS) + ", is_delayed int")


@pytest.mark.parametrize("model_type,kw", [("lr", {}), ("rf", {"rf_trees": 10}),
                                           ("xgboost", {"gbt_rounds": 10})])
def test_train(matrix, model_type, kw):
    model = M.train_model(matrix, model_type, feature_cols=COLS, **kw)
    out = M.predict(model, matrix)
    assert {"probability_delayed", "predicted"} <= set(out.columns)
    assert out.count() == 100


def test_unknown_model_type(matrix):
    with pytest.raises(ValueError):
        M.train_model(matrix, "svm", feature_cols=COLS)


def test_evaluate_model(matrix):
    model = M.train_model(matrix, "xgboost", feature_cols=COLS, gbt_rounds=10)
    m = evaluate_model(model, matrix).first().asDict()
    for k in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"):
        assert 0.0 <= m[k] <= 1.0


def test_save_load_model(matrix, tmp_dir):
    model = M.train_model(matrix, "lr", feature_cols=COLS)
    M.save_model(model, f"{tmp_dir}/lr_model")
    loaded = M.load_all_models(matrix.sparkSession, tmp_dir)["lr"]
    a = [r[0] for r in M.predict(model, matrix).orderBy("feature_0").select("predicted").collect()]
    b = [r[0] for r in M.predict(loaded, matrix).orderBy("feature_0").select("predicted").collect()]
    assert a == b


def test_balanced_lr_regularisation(matrix):
    model = M.train_model(matrix, "lr", feature_cols=COLS)
    clf = M.classifier(model)
    assert clf.getRegParam() == pytest.approx(1.0 / 100)  # sum of balanced weights = n


def test_feature_importances(matrix):
    model = M.train_model(matrix, "rf", feature_cols=COLS, rf_trees=10)
    imp = M.feature_importances(matrix.sparkSession, model, top_n=5).collect()
    assert len(imp) == 5 and imp[0]["importance"] >= imp[-1]["importance"]


def test_linear_attribution_is_additive(matrix):
    from ontime_spark.plans.score import linear_explanations
    model = M.train_model(matrix, "lr", feature_cols=COLS)
    out = linear_explanations(model, model.transform(matrix)).select(
        "raw_margin", F.col("rawPrediction")).collect()
    for r in out:
        assert r["raw_margin"] == pytest.approx(float(r["rawPrediction"][1]), abs=1e-9)
