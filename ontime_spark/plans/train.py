"""Training job (L8): preprocess -> features -> temporal split -> three classifiers ->
evaluation -> saved models and a comparison table.

Plan notes: the train and test matrices are written once as Parquet to the shared checkpoint
folder before the three fits (each iterates over the training matrix many times), so no fit
recomputes the feature joins and a lost executor re-reads files. Files of ``MATRIX_ROWS`` rows keep a
task's share small however few tasks wrote them: 3.5 million rows compress to one row group of 120 MB,
which cannot be split, and a fit holds a partition's rows as doubles, on disk if they don't fit.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark import schemas as S
from ontime_spark.operators import clean
from ontime_spark.operators import evaluate as EV
from ontime_spark.operators import features as FE
from ontime_spark.operators import featurizer as FP
from ontime_spark.operators import models as M
from ontime_spark.session import materialize


#: Rows of a file of the train and test matrices.
MATRIX_ROWS = 250_000


def evaluate_model(model, test: DataFrame, label: str = S.TARGET_COL,
                   name: str | None = None) -> DataFrame:
    """M6 for a fitted model on a labelled numeric matrix."""
    scored = M.predict(model, test).select(F.col(label).alias("label"),
                                           F.col("probability_delayed").alias("score"))
    return EV.classification_metrics(scored, model=name)


def prepare_matrices(flights: DataFrame, leakage_safe: bool = True,
                     hubs: Iterable[str] = S.HUB_AIRPORTS,
                     keep: Sequence[str] = (), preprocessed: bool = False) -> tuple[DataFrame, DataFrame, object]:
    """Flights -> preprocessed flights (the given ones if ``preprocessed``) -> (train matrix, test
    matrix, fitted featurizer or None).

    leakage_safe=True fits the route/carrier encoder on the training months only (the
    documented intent); False reproduces the in-sample encoding of the original training
    script (``build_features`` on all rows before the split)."""
    pre = flights if preprocessed else clean.preprocess(flights, materialize=True)
    if leakage_safe:
        train_raw, test_raw = FP.temporal_split(pre)
        fz = FP.FlightFeaturizer(hubs=hubs).fit(train_raw)
        # Both sides look back on the same airport-day table, made once.
        rates = materialize(FE.airport_daily_rates(pre), "airport-rates")
        train = fz.transform(train_raw, rates=rates, keep=keep)
        test = fz.transform(test_raw, rates=rates, keep=keep)
    else:
        feats = FP.align_features(FE.build_features(pre, hubs=hubs), keep=[*keep, "fl_date"])
        train, test = FP.temporal_split(feats)
        fz = None
    return (FP.numeric_matrix(train, keep=keep), FP.numeric_matrix(test, keep=keep), fz)


def train_all_models(train: DataFrame, test: DataFrame, models_dir: str | None = None,
                     model_types: Sequence[str] = M.MODEL_TYPES, **model_kwargs) -> dict:
    """L8 core: fit each type, evaluate on test, save. Returns
    {type: {"model", "metrics" (1-row DataFrame), "path"}}."""
    train, test = (materialize(m, f"{n}-matrix", MATRIX_ROWS) for n, m in (("train", train), ("test", test)))
    results = {}
    for t in model_types:
        kw = {k: v for k, v in model_kwargs.items()
              if (k == "rf_trees" and t == "rf") or (k == "gbt_rounds" and t == "xgboost")}
        model = M.train_model(train, t, **kw)
        metrics = materialize(evaluate_model(model, test, name=t), f"metrics-{t}")
        path = M.save_model(model, os.path.join(models_dir, f"{t}_model")) if models_dir else None
        results[t] = {"model": model, "metrics": metrics, "path": path}
    return results


def train_job(flights: DataFrame, models_dir: str | None = None, leakage_safe: bool = True,
              hubs: Iterable[str] = S.HUB_AIRPORTS, model_types: Sequence[str] = M.MODEL_TYPES,
              preprocessed: bool = False, **model_kwargs) -> tuple[dict, DataFrame]:
    """Returns (results per model, comparison table ordered by pr_auc). ``preprocessed``: the
    flights are labelled and filled already, as ``clean.preprocess`` does it."""
    for t in model_types:
        if t not in M.MODEL_TYPES:
            raise ValueError(f"no model type {t!r}; there are {', '.join(M.MODEL_TYPES)}")
    train, test, fz = prepare_matrices(flights, leakage_safe, hubs, preprocessed=preprocessed)
    results = train_all_models(train, test, models_dir, model_types, **model_kwargs)
    if fz is not None and models_dir:
        fz.save(os.path.join(models_dir, "featurizer"))
    comparison = EV.compare_models({t: r["metrics"] for t, r in results.items()})
    return results, comparison
